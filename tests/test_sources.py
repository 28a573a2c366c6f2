import gzip

import pytest

from sporeline.sources import fastx


def test_fasta_round_trip(spark, tmp_path):
    seqs = spark.createDataFrame([("a", 3, "ACGT"), ("b", 1, "GG")], "id string, size long, seq string")
    fastx.write_fasta(seqs, str(tmp_path / "out"))
    back = fastx.read_fasta(spark, str(tmp_path / "out"), size_required=True).select("id", "size", "seq")
    assert sorted(back.collect()) == sorted(seqs.collect())


def test_fasta_lines_and_case(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">s1;size=2\r\nac\r\ngt\r\n>s2\nTT\n")
    rows = {r.id: (r.size, r.seq) for r in fastx.read_fasta(spark, str(tmp_path / "x.fa")).collect()}
    assert rows == {"s1": (2, "ACGT"), "s2": (None, "TT")}
    assert fastx.sniff(spark, str(tmp_path / "x.fa")) == "fasta"


def test_fastq_gzip_pairs_and_bad_records(spark, tmp_path):
    (tmp_path / "s1.fastq.gz").write_bytes(gzip.compress(b"@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n"))
    (tmp_path / "s2.fq").write_text("@r1\nTT\n+\nII\n@bad\nAC\n+\nI\n")
    rows = fastx.read_fastq(spark, str(tmp_path / fastx.FASTQ_GLOB), strict=False).collect()
    assert sorted((r.SampleID, r.id, r.bad) for r in rows) == [("s1", "r1", None), ("s1", "r2", None), ("s2", "bad", "length"), ("s2", "r1", None)]
    assert fastx.read_pairs(spark, str(tmp_path / "s1.fastq.gz"), str(tmp_path / "s1.fastq.gz")).count() == 2
    with pytest.raises(Exception, match="bad record"):
        fastx.read_fastq(spark, str(tmp_path / "s2.fq")).collect()


def test_tolerant_and_uc(spark, tmp_path):
    from sporeline.operators.membership import parse_uc

    assert fastx.read_tolerant(spark, str(tmp_path / "none"), "a string, b double").count() == 0
    pairs = spark.createDataFrame([("H", "q1;size=2", "t1;size=9"), ("S", "t1;size=9", None), ("C", "t1", None)], "type string, query string, target string")
    fastx.write_uc(pairs, str(tmp_path / "uc"))
    assert sorted(map(tuple, parse_uc(spark.read.text(str(tmp_path / "uc"))).collect())) == [("q1", "t1"), ("t1", "t1")]


def test_incremental_totals(spark, tmp_path):
    from sporeline.streaming import ingest

    schema = "OTU string, SampleID string, Abundance long"
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    for amount in (2, 5):
        spark.createDataFrame([("o", "s", amount)], schema).write.mode("append").parquet(src)
        ingest.ingest(spark, src, schema, out, cp)
    ingest.ingest(spark, src, schema, out, cp)
    assert [tuple(r) for r in ingest.totals(spark, out).collect()] == [("o", "s", 7)]


def test_unreadable_files_give_what_can_be_read(spark, tmp_path):
    (tmp_path / "empty.tsv").write_text("")
    (tmp_path / "bad.tsv.gz").write_bytes(gzip.compress(b"x\t1.5\n" * 1000)[:20])
    assert fastx.read_tolerant(spark, str(tmp_path / "empty.tsv"), "a string, b double").count() == 0
    assert fastx.read_tolerant(spark, str(tmp_path / "bad.tsv.gz"), "a string, b double").columns == ["a", "b"]
    assert fastx.read_tolerant(spark, str(tmp_path / "bad.tsv.gz"), "a string, b double").count() in range(1001)


def test_single_and_multiple_libraries(spark, tmp_path):
    table = spark.createDataFrame([("s", 1)], "SeqID string, Abundance long")
    for run in ("Run 1", "Run2"):
        table.write.parquet(str(tmp_path / "many" / run / "07_SeqTable" / "Seqs.parquet"))
    table.write.parquet(str(tmp_path / "one" / "07_SeqTable" / "Seqs.parquet"))
    assert [tuple(r) for r in fastx.read_libraries(spark, str(tmp_path / "one")).collect()] == [("s", 1, None)]
    assert sorted(map(tuple, fastx.read_libraries(spark, str(tmp_path / "many")).collect())) == [("s", 1, "Run 1"), ("s", 1, "Run2")]
    with pytest.raises(FileNotFoundError):
        fastx.read_libraries(spark, str(tmp_path / "none"))


def test_settings(spark, tmp_path):
    from sporeline.functions import settings
    from sporeline.plans.steps import Params

    (tmp_path / "p.tsv").write_text("max_ee_rate\tNA\r\n# note\r\nlulu\tTRUE\r\n\r\nclustering\tswarm\r\n")
    (tmp_path / "p.yml").write_text("max_n: 2\nprimer_forward: 'ACGT'\npreclustering: none\n")
    p = settings.apply(Params(), fastx.read_params(spark, str(tmp_path / "p.tsv")) | fastx.read_params(spark, str(tmp_path / "p.yml")))
    assert p == Params(max_ee_rate=None, lulu=True, clustering="swarm", max_n=2, primer_forward="ACGT")
    assert settings.flag(" Yes ") and not settings.flag("0") and settings.flag("NULL", True) and settings.present(" na ") is None
    for bad in ({"nope": "1"}, {"max_n": "NA"}, {"lulu": "maybe"}):
        with pytest.raises(ValueError):
            settings.apply(Params(), bad)
    odd = "it's a \\ 'test'"
    assert spark.sql(f"SELECT {settings.sql_text(odd)} AS x").first().x == odd


def test_barcodes_and_files_by_sample(spark, tmp_path):
    (tmp_path / "b.fa").write_bytes(b">s1\r\nacgt\r\n>s2\r\nTTGA\r\n")
    assert sorted(map(tuple, fastx.read_barcodes(spark, str(tmp_path / "b.fa")).collect())) == [("s1", "ACGT"), ("s2", "TTGA")]
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "SampleID string, n long")
    fastx.write_by_sample(rows, str(tmp_path / "out"))
    own = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "out" / "SampleID=a"))
    assert sorted(r.n for r in own.collect()) == ["1", "3"]


def plain_fastq(data):
    """(record, id, seq, qual, bad) line by line."""
    out, record, n = [], [], 0
    for line in [*data.split("\n")[: -1 if data.endswith("\n") else None], None]:
        if line is not None and (record or line):
            record.append(line)
        if record and (line is None or len(record) == 4):
            head, seq, plus, qual = (record + [""] * 4)[:4]
            bad = "truncated" if len(record) < 4 else "header" if head[:1] != "@" else "plus" if plus[:1] != "+" else "length" if len(seq) != len(qual) else None
            out.append((n, head[1:].split(" ")[0], seq, qual, bad))
            n, record = n + 1, []
    return out


def test_fastq_is_the_same_at_every_split(spark, tmp_path):
    import random

    rng = random.Random(1)
    text = ""
    for i in range(60):
        n = rng.choice([0, 3, 50])
        text += "\n" * rng.choice([0, 0, 0, 1, 3]) + f"@r{i} x\n{'A' * n}\n+\n{rng.choice('@+I') * n}\n"
    text += "@cut\nACGT\n"
    (tmp_path / "a+b c.fastq").write_text(text)
    (tmp_path / "z.fq.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "empty.fq").write_text("")
    want = plain_fastq(text)
    assert len(want) == 61 and want[-1][-1] == "truncated"
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("37", "64", "400", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            rows = fastx.read_fastq(spark, [str(tmp_path / x) for x in ("a+b c.fastq", "z.fq.gz", "empty.fq")], strict=False).collect()
            for sample in ("a+b c", "z"):
                assert sorted((r.record, r.id, r.seq, r.qual, r.bad) for r in rows if r.SampleID == sample) == want, size
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def bam_bytes(reads, block):
    """A BAM file of (name, flag, seq, qual) in BGZF blocks of so many bytes."""
    import struct
    import zlib

    raw = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 1000)
    for name, flag, seq, qual in reads:
        code = [b"=ACMGRSVTWYHKDBN".index(c.encode()) for c in seq]
        packed = bytes((a << 4) | b for a, b in zip(code[::2], [*code[1::2], 0]))
        body = struct.pack("<iiBBHHHiiii", -1, -1, len(name) + 1, 0, 4680, 0, flag, len(seq), -1, -1, 0)
        body += name.encode() + b"\0" + packed + (b"\xff" * len(seq) if qual is None else bytes(ord(c) - 33 for c in qual)) + b"npi\x05\0\0\0"
        raw += struct.pack("<i", len(body)) + body
    out = b""
    for part in [raw[i : i + block] for i in range(0, len(raw), block)] + [b""]:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = z.compress(part) + z.flush()
        out += b"\x1f\x8b\x08\4\0\0\0\0\0\xff\6\0BC\2\0" + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def test_bam_over_several_splits(spark, tmp_path):
    import random

    from sporeline.sources import bam

    rng = random.Random(2)
    made = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    reads = []
    for i in range(150):
        n = rng.choice([0, 1, 30, 31, 900])
        reads.append((f"m/{i}/ccs", rng.choice([4, 4, 16]), made(n, "ACGTN"), made(n, "!+5?I") if i % 7 else None))
    reads += [("second", 256, "ACGT", "IIII")]
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    want = sorted((n, turn(s) if f & 16 else s, q if q is None or not f & 16 else q[::-1]) for n, f, s, q in reads[:-1])
    want = sorted(((a, b, c if b else (c or None)) for a, b, c in want), key=repr)
    for block in (60, 700, 60_000):
        (tmp_path / f"s{block}.bam").write_bytes(bam_bytes(reads, block))
        for split in (150, 3000, 10**9):
            df = bam.read_bam(spark, str(tmp_path / f"s{block}.bam"), split)
            got = df.collect()
            assert sorted(((r.id, r.seq, r.qual or None) for r in got), key=repr) == sorted(((a, b, c or None) for a, b, c in want), key=repr), (block, split)
            assert {r.SampleID for r in got} == {f"s{block}"}
        assert bam.read_bam(spark, str(tmp_path / f"s{block}.bam"), 3000).rdd.getNumPartitions() > 1
    (tmp_path / "no.bam").write_bytes(bam_bytes([], 100))
    assert bam.read_bam(spark, str(tmp_path / "no.bam")).collect() == []
