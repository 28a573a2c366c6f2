import random
import re
import zlib
from collections import Counter

import pytest

from sporeline.llm import spelling
from tests.oracle import rows_match


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{w}".encode())
            if doc is not None and h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    form, out = {}, []
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = (best if best and n[best] >= 2 * n[w] else None, len(near))
    for w in n:
        root = w
        while form[root][0]:
            root = form[root][0]
        f, k = form[w]
        out.append((w, f, root, n[w], k, n[f] if f else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_each_half_finds_its_neighbours_once_in_few_shards():
    rng = random.Random(5)
    for trial in range(40):
        letters = "ab" if trial % 2 else "abcdé"
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(80)})
        both = []
        for back in (False, True):
            own = sorted(w[::-1].encode("latin-1") if back else w.encode("latin-1") for w in words)
            k = rng.randint(1, 30)
            cut = [own[i : i + k] for i in range(0, len(own), k)]
            both.append(spelling.Shards([(c[0].decode("latin-1"), c[-1].decode("latin-1"), spelling.Trie(c, [1] * len(c)).packed()) for c in cut], back))
        for w in words + ["", "b" * 9, "zz"]:
            got = [x for _, x in both[0].near(w.encode("latin-1"))] + [x[::-1] for _, x in both[1].near(w[::-1].encode("latin-1"))]
            assert sorted(x.decode("latin-1") for x in got) == [x for x in words if one_edit(w, x)]
    many = sorted("".join(rng.choice("abcdefgh") for _ in range(8)).encode() for _ in range(1000))
    shards = spelling.Shards([(many[i].decode(), many[i + 9].decode(), spelling.Trie(many[i : i + 10], [1] * 10).packed()) for i in range(0, 1000, 10)], False)
    shards.near(many[500])
    assert sum(t is not None for t in shards.tries) <= 2


def test_automaton_against_brute_force():
    rng = random.Random(2)
    for trial in range(40):
        letters = "ab" if trial % 2 else "abcdé"
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(60)})
        coded = [w.encode("latin-1") for w in words]
        trie = spelling.Trie.unpacked(spelling.Trie(coded, list(range(len(words)))).packed())
        for w in words + ["", "b" * 9, "zz"]:
            got = [words[i] for i in trie.near(w.encode("latin-1"))]
            assert sorted(got) == [x for x in words if one_edit(w, x)], (w, got)


def test_long_words():
    words = sorted(("a" * 30_000 + x + "b" * 30_000).encode() for x in ("", "c", "d", "cc"))
    trie = spelling.Trie(words, [1] * 4)
    assert [len(trie.near(w)) for w in words] == [sum(one_edit_long(w, x) for x in words) for w in words]


def one_edit_long(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] or a[p:] == b[p + 1 :] or a[p + 1 :] == b[p:]


@pytest.mark.parametrize("shard,most", [(spelling.SHARD_WORDS, spelling.BROADCAST_BYTES), (7, 300)])
def test_chains_over_shards(spark, shard, most):
    rng = random.Random(9)
    n = {}
    for _ in range(150):
        w = "".join(rng.choice("abc") for _ in range(rng.randint(5, 7)))
        n[w] = rng.choice([3, 3, 6, 7, 12, 30, 80])
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = rows_of(spelling.variants(df, shard, most))
    assert got == brute(n) and any(r[1] and r[2] != r[1] for r in got)


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    base = ["Straße straße STRASSE strasse", "İstanbul istanbul ıstanbul stanbul", "ÀÉÎ×÷ àéî×÷ hello-world helloworld", "x" * 5000, "a1b2c3 colour color colours", ""]
    rows = [(i, base[i % 6]) for i in range(400)] + [(None, base[0])] * 4 + [(5, None), (7, base[5]), (7, base[1]), (7, base[1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long").repartition(3)
    want = brute_words(rows)
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == want
    assert rows_of(spelling.variants(spelling.vocabulary(df))) == brute(want)


def test_query_against_sql(spark):
    assert rows_match(spark, spelling.op11_spelling_variants, spelling.ORACLE, "/root/testdata/sf0.001") > 1000


def test_empty_table(spark, none):
    assert spelling.op11_spelling_variants(spark, none).collect() == []
