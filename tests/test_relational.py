"""Orders, checks and defaults that are no tables of their own."""

import pytest

from sporeline.operators import relational as R


def test_orders_put_nulls_in_their_places(spark):
    rows = spark.createDataFrame([("b", 5, None), ("a", 5, 30.0), ("c", 5, 30.0), ("d", None, 40.0), ("e", 9, 1.0)], "SeqID string, Abundance long, PhredScore double")
    assert [r.SeqID for r in R.by_abundance(rows).collect()] == ["e", "a", "c", "b", "d"]
    sized = spark.createDataFrame([("x", 1), (None, 7), ("w", 7), ("z", None)], "id string, size long")
    assert [r.id for r in R.by_size(sized).collect()] == ["w", None, "x", "z"]
    assert [r.id for r in R.merge_buckets([sized.filter("size = 7"), sized.filter("size = 1").withColumnRenamed("size", "size")]).collect()] == ["w", None, "x"]
    cells = spark.createDataFrame([("s", 1, "o1"), (None, 1, "o2"), ("s", 3, "o3"), ("s", 3, "o2")], "SampleID string, Abundance long, OTU string")
    assert [(r.SampleID, r.OTU) for r in R.by_sample(cells).collect()] == [(None, "o2"), ("s", "o2"), ("s", "o3"), ("s", "o1")]
    members = spark.createDataFrame([(i % 3, i % 5, i) for i in range(60)], "BucketID long, size long, SeqIndex long")
    got = [(r.BucketID, -r.size, r.SeqIndex) for r in R.in_buckets(members).collect()]
    assert sorted(got) == sorted((i % 3, -(i % 5), i) for i in range(60))
    for b in range(3):
        own = [x for x in got if x[0] == b]
        assert own == sorted(own) and [x[0] for x in got].index(b) + len(own) - 1 == max(k for k, x in enumerate(got) if x[0] == b)


def test_checks_list_offenders(spark):
    ids, known = (spark.createDataFrame([(x,) for x in xs], "id long") for xs in ([1, 2, 2, 3, 9, 8, 7, 6, 5], [1, 2, 3]))
    assert R.missing(ids, known, "id") == (5, [5, 6, 7, 8, 9])
    with pytest.raises(ValueError, match="5 of id not found, such as 5, 6, 7, 8, 9"):
        R.require_known(ids, known, "id")
    R.require_known(known, ids, "id")
    assert R.require_unique(known, "id").count() == 3
    with pytest.raises(ValueError, match=r"\[2\]"):
        R.require_unique(ids, "id")
    assert R.or_default(known.filter("id > 5"), ids).count() == 9 and R.or_default(known, ids).count() == 3
