"""The pipeline against a brute-force version of its filters."""

import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from sporeline.llm import bpe, catalog
from sporeline.llm.common import shared_dir
from tests.llm.test_exact import brute_groups, brute_prints

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id for r in catalog.queries()["op9_quality_rules"](spark, SF).collect() if r.kept}
    groups = brute_groups({i: brute_prints(docs[i]) for i in kept})
    kept = {i for i in kept if groups[i] == i}
    bad = {r.doc_id for r in catalog.queries()["op5_decontaminate"](spark, SF).collect() if r.contaminated}
    secret = {r.doc_id for r in catalog.queries()["op10_secret_ledger"](spark, SF).collect() if r.spans}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == kept - bad and out
    ranks = bpe.Vocabulary(open(P.path("byte_bpe_50k.tiktoken"), "rb").read(), P.PATTERN).ranks
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in out.items():
        if i in secret:
            assert "<secret>" in enc.decode(r.ids)
        else:
            assert np.array_equal(r.ids, enc.encode_ordinary(docs[i]))


def test_stages_keep_columns_as_they_are(spark, odd):
    """Extra columns with names that operators use inside, or return, keep their values in every stage."""
    names = ["_t", "_w", "_h", "_salt", "salt", "_key", "key", "_c", "c", "_id", "id", "own", "w", "hit", "blob", "fp", "print", "of", "n", "n_hit", "contaminated", "root", "new", "high_upper"]
    docs = spark.read.parquet(f"{odd}/documents.parquet").filter("text is not null and length(text) < 3000")
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names])
    had = {r.doc_id: r.asDict() for r in docs.collect()}
    kept = 0
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, odd)
        assert out.columns == docs.columns, name
        for r in out.collect():
            own = {k: v for k, v in r.asDict().items() if name != "secrets" or k not in ("text", "n_chars")}
            assert own == {k: had[r.doc_id][k] for k in own}, name
            kept += 1
    assert kept > 20


def test_odd_and_empty_tables_go_through(spark, odd, none):
    assert corpus_pipeline.run(spark, none).count() == 0
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = shared_dir(spark)
        stage(spark, docs, odd).write.parquet(path)
        new = spark.read.parquet(path)
        if name != "encode":
            assert new.columns == docs.columns
        docs = new
    assert docs.count() > 0
