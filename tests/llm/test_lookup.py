"""That token files have stripes, row indexes and Bloom filters, and that a lookup reads little."""

import glob

import pyarrow.orc as po
from pyspark.sql import functions as F

from sporeline.llm import tokenfile
from sporeline.llm.common import shared_dir


def rows_read(df):
    """Rows that came out of the scan of a table while df was collected."""
    leaf = df._jdf.queryExecution().executedPlan()
    while leaf.children().size():
        leaf = leaf.children().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_rows(spark):
    import public_tokenizers as P

    n = 24_000
    docs = spark.range(n).select((F.col("id") * 7919 % 100_003).alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    path = shared_dir(spark)
    tokenfile.write(docs, open(P.path("word_bpe_49k.json"), encoding="utf-8").read(), path, 2)
    files = sorted(glob.glob(f"{path}/*.orc"))
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    stripes = [po.ORCFile(f) for f in files]
    assert sum(f.nrows for f in stripes) == n and all(f.nstripes >= 1 for f in stripes)
    # The footer names the index stride; a Bloom filter stands in each stripe's index (streams of kind 7 or 8).
    assert all(f.row_index_stride == 1_000 for f in stripes)
    known = 5 * 7919 % 100_003
    found = tokenfile.lookup(spark, path, [known])
    rows = found.collect()
    assert [r.doc_id for r in rows] == [known] and rows[0].ids[-1] == 2
    assert rows_read(found) <= 2_000 < n
    whole = tokenfile.read(spark, path)
    whole.collect()
    assert rows_read(whole) == n
    # An id within the range of a file's statistics that no document has: row groups go by the Bloom filter as well.
    held = {r.doc_id for r in whole.select("doc_id").collect()}
    absent = [i for i in range(50_000, 50_400) if i not in held][:20]
    got = [tokenfile.lookup(spark, path, [i]) for i in absent]
    assert all(x.collect() == [] for x in got)
    assert sum(rows_read(x) == 0 for x in got) >= len(absent) * 0.8
