import hashlib
import random

import pytest

from sporeline.llm import suffixes
from sporeline.llm.common import table


def brute(rows, w):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, bytes)."""
    first = {}
    for d, t in rows:
        d = float("inf") if d is None else d
        for i in range(len(t) - w + 1):
            k = t[i : i + w]
            if d < first.get(k, float("inf")):
                first[k] = d
    out = []
    for d, t in rows:
        covered = bytearray(len(t))
        for i in range(len(t) - w + 1):
            if first.get(t[i : i + w], float("inf")) < (float("inf") if d is None else d):
                covered[i : i + w] = b"\1" * w
        kept = bytes(b for b, c in zip(t, covered) if not c)
        runs = sum(c and not p for p, c in zip(b"\0" + bytes(covered), covered))
        out.append((d, len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def digests(out):
    from pyspark.sql import functions as F

    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def test_intervals_equal_brute_force():
    rng = random.Random(3)
    for trial in range(60):
        w, letters = rng.choice([8, 9, 17]), b"ab" if trial % 2 else b"abcdefgh"
        make = lambda n: bytes(rng.choice(letters) for _ in range(n))
        pool = [make(rng.randint(5, 60)) for _ in range(4)]
        strings = list({b"".join(rng.choice(pool) for _ in range(rng.randint(0, 4))) + make(rng.randint(0, 9)) for _ in range(8)})
        got, want = {}, {}
        for iv, s, at in zip(*(x.tolist() for x in suffixes.repeated_windows(strings, w, rng.choice([1, 60, 1000])))):
            got.setdefault(iv, []).append((s, at))
        for i, t in enumerate(strings):
            for p in range(len(t) - w + 1):
                want.setdefault(t[p : p + w], []).append((i, p))
        assert [sorted(v) for k, v in sorted(want.items()) if len(v) > 1] == [sorted(got[k]) for k in sorted(got)]


def test_suffix_order_is_sorted():
    import numpy as np

    strings = [b"banana", b"", b"ana", b"banana", b"b" * 40, b"b" * 39]
    data = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).copy()
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    want = sorted((s[i:], j, i) for j, s in enumerate(strings) for i in range(len(s) + 1))
    begins = [0, *(ends[:-1] + 1)]
    assert suffixes.suffix_order(data, ends).tolist() == [begins[j] + i for _, j, i in want]


@pytest.mark.parametrize("hot,block", [(suffixes.HOT, suffixes.BLOCK_BYTES), (1, 3000)])
def test_odd_rows(spark, monkeypatch, hot, block):
    rng = random.Random(5)
    line = "".join(rng.choice("abcdefgh ") for _ in range(90))
    texts = [line, None, "", "short", line + "é" * 30 + line, "x" + line[:60] + "y" + line[20:], "a" * 700, "b" + "a" * 300, "é" * 40, "漢" + "é" * 45, line]
    texts += [line[i : i + 55] + str(i) * 20 for i in range(0, 35, 3)]
    long = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [(i * 3 % 23, t) for i, t in enumerate(texts)] + [(None, line), (None, line), (0, line), (99, long), (7, long[1000:4000]), (98, long[:3000] + "z")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, kept string").repartition(3)
    monkeypatch.setattr(suffixes, "PART", 1000)
    for name in ("BUCKET_BYTES", "GROUP_BYTES"):
        monkeypatch.setattr(suffixes, name, block)
    out = digests(suffixes.drop_repeated(df, hot=hot, block_bytes=block, shard_bytes=500))
    want = brute([(d, (t or "").encode()) for d, t in rows], 50)
    assert rows_of(out) == sorted(((None if d == float("inf") else d, *r) for d, *r in want), key=repr)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, (r.text or "").encode()) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = rows_of(suffixes.op13_suffix_dedup(spark, sf))
    assert got == brute(rows, 50) and sum(r[2] for r in got) > 1000


def test_empty_table(spark, none):
    assert suffixes.op13_suffix_dedup(spark, none).collect() == []
