"""Quality rules with adaptive thresholds (DataFrame operations only).

Fixed rules reject what is broken in any corpus (too few words, mostly repeated five-word windows). The other rules
compare a document with its own language and source: a mergeable sketch of every metric gives quantiles of each
(language, source), and a document is rejected where a metric lies beyond the upper (or lower) fence, which is ``reach``
times as far from an outer quantile as that is from the median.

The sketch is a log-linear histogram of integers: a value keeps its six leading binary digits, so a bucket is at most
1/32 wide relative to its value, a group has a bounded number of buckets, sketches merge by adding counts, and the
result does not depend on partitioning. Groups of fewer than ``min_docs`` documents use their language's merged
sketch, and languages below it that of the whole corpus.

Defined cases: a null text has no words and is rejected; a null language or source counts as ''; repeated rows are
judged separately and alike; an empty table gives an empty result; extra columns stay whatever their names, but
``features`` and ``judge``, which add columns, replace those of the input that have a result column's name;
``quality_filter`` returns the input's columns as they were; very long texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sporeline.llm.common import settle, table

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
#: Metric -> per-mille expression over the features; all are integers, so engines agree.
METRICS = {
    "symbols": "1000 * n_symbols div n_words",
    "dup_lines": "1000 * n_dup_lines div n_lines",
    "word_len": "1000 * word_chars div n_words",
    "upper": "1000 * n_upper div word_chars",
}


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    min_docs: int = 200
    #: Distance of the fences from the outer quantile, in distances between it and the median.
    reach: int = 6
    #: Least such distance by metric, for groups in which most documents have the same value.
    floor: dict = field(default_factory=lambda: {"symbols": 15, "dup_lines": 60, "word_len": 50, "upper": 4})
    #: Outer quantiles by metric, in twentieths: of the lower fence, if there is one, and of the upper.
    outer: dict = field(default_factory=lambda: {"symbols": (0, 15), "dup_lines": (0, 19), "word_len": (1, 19), "upper": (0, 19)})
    #: Copies of each group's thresholds over which a hot group's documents are dealt.
    salts: int = 8


def _features(docs: DataFrame, carry: list[str]) -> DataFrame:
    """own (a struct of the columns in carry, so that no name can clash), lang, source and the FEATURES as long columns.

    Every whole text is read in one pass, without a shuffle. Windows are compared by a 64-bit hash of their five words'
    64-bit hashes.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    group = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    out = docs.select(own.alias("own"), *group, F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    out = out.withColumn("_w", F.expr(r"filter(split(_t, '[\\x20\\x09-\\x0D]+'), w -> w != '')"))
    out = out.withColumn("_lines", F.expr(r"filter(split(_t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    out = out.withColumn("_h", F.expr("transform(_w, w -> xxhash64(w))"))
    out = out.select(
        "own", "lang", "source",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all("_t", F.lit(r"[#*$%&|<>]"), F.lit(0))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("_t", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.expr(
            "if(size(_h) < 5, array(), transform(slice(_h, 1, greatest(size(_h) - 4, 1)), "
            "(h, i) -> xxhash64(h, _h[i + 1], _h[i + 2], _h[i + 3], _h[i + 4])))"
        ).cast("array<long>").alias("_v"),
    )
    # Only texts in which some window occurs twice are sorted.
    out = out.withColumn(
        "_s",
        F.expr(
            "if(size(array_distinct(_v)) = size(_v), array(), sort_array(transform(_v, (h, i) -> struct(h, i))))"
        ).cast("array<struct<h:long,i:int>>"),
    )
    out = out.withColumn(
        "_p",
        F.expr(
            "sort_array(transform(filter(_s, (e, k) -> (k > 0 and _s[greatest(k - 1, 0)].h = e.h) or "
            "(k < size(_s) - 1 and _s[least(k + 1, size(_s) - 1)].h = e.h)), e -> e.i))"
        ),
    )
    covered = (
        "aggregate(transform(_p, (x, k) -> if(k < size(_p) - 1, least(5, _p[least(k + 1, size(_p) - 1)] - x), 5)), "
        "0L, (a, x) -> a + x)"
    )
    out = out.withColumn("n_repeat_words", F.expr(covered))
    # The generator keeps later filters on the features from being pushed below, where Catalyst would put the whole
    # expressions in their place and evaluate them once for each word.
    return out.select("own", "lang", "source", F.inline(F.array(F.struct(*FEATURES))))


def _with(found: DataFrame, own: list[str], added: list[str]) -> DataFrame:
    """The input's columns but those that have an added column's name, then the added ones."""
    return found.select(*[F.col(f"own.`{c}`").alias(c) for c in own if c not in added], *added)


def features(docs: DataFrame) -> DataFrame:
    """docs with the FEATURES."""
    return _with(_features(docs, docs.columns), docs.columns, list(FEATURES))


def _bucket(value: Column) -> Column:
    """The value with all but its six leading binary digits cleared."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketch(feats: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): mergeable by adding n. One row per occupied bucket."""
    each = F.explode(
        F.array(*[F.struct(F.lit(m).alias("metric"), F.expr(e).alias("value")) for m, e in METRICS.items()])
    )
    rows = feats.select("lang", "source", each.alias("e"))
    return (
        rows.select("lang", "source", "e.metric", _bucket(F.col("e.value")).alias("bucket"))
        .groupBy("lang", "source", "metric", "bucket")
        .agg(F.count("*").alias("n"))
    )


def thresholds(sketches: DataFrame, rules: Rules) -> DataFrame:
    """(lang, source, metric, low, high) for each group of the sketches, from itself or what it merges into."""
    level = F.explode(
        F.array(
            F.struct(F.lit(0).alias("level"), F.col("lang").alias("l"), F.col("source").alias("s")),
            F.struct(F.lit(1).alias("level"), F.col("lang").alias("l"), F.lit("").alias("s")),
            F.struct(F.lit(2).alias("level"), F.lit("").alias("l"), F.lit("").alias("s")),
        )
    )
    merged = (
        sketches.select("metric", "bucket", "n", level.alias("g"))
        .groupBy("g.level", "g.l", "g.s", "metric", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    of = W.partitionBy("level", "l", "s", "metric")
    ranked = merged.withColumn("upto", F.sum("n").over(of.orderBy("bucket"))).withColumn("total", F.sum("n").over(of))
    def of_metric(values: dict) -> Column:
        return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("metric")]

    floor = of_metric(rules.floor)
    low_at, high_at = (of_metric({m: v[k] for m, v in rules.outer.items()}) for k in (0, 1))

    def quantile(at: Column | int) -> Column:
        return F.min(F.when(20 * F.col("upto") >= at * F.col("total"), F.col("bucket")))

    fences = (
        ranked.groupBy("level", "l", "s", "metric")
        .agg(
            F.first("total").alias("total"),
            quantile(low_at).alias("lo"), quantile(F.lit(10)).alias("mid"), quantile(high_at).alias("hi"),
        )
        .select(
            "level", "l", "s", "metric", "total",
            F.when(low_at > 0, F.col("lo") - rules.reach * F.greatest(F.col("mid") - F.col("lo"), floor)).alias("low"),
            (F.col("hi") + rules.reach * F.greatest(F.col("hi") - F.col("mid"), floor)).alias("high"),
        )
    )
    # A group takes the first of its three levels that has enough documents; the last level always serves.
    groups = sketches.select("lang", "source").distinct()
    levels = groups.select("lang", "source", F.explode(F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang").alias("l"), F.col("source").alias("s")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("l"), F.lit("").alias("s")),
        F.struct(F.lit(2).alias("level"), F.lit("").alias("l"), F.lit("").alias("s")),
    )).alias("g")).select("lang", "source", "g.*")
    return (
        levels.join(fences, ["level", "l", "s"])
        .filter((F.col("total") >= rules.min_docs) | (F.col("level") == 2))
        .groupBy("lang", "source", "metric")
        .agg(F.min_by(F.struct("low", "high"), "level").alias("f"))
        .select("lang", "source", "metric", "f.low", "f.high")
    )


def _judged(docs: DataFrame, rules: Rules, carry: list[str]) -> DataFrame:
    """own, FEATURES, base_failed and kept. Texts are read once: the features are written with what is carried, and the
    sketches and the verdicts are made from them.

    The thresholds' join is on (language, source) and a salt of the row, so that a hot source is dealt over
    ``rules.salts`` tasks where the thresholds are too many to be broadcast (Spark checks their size).
    """
    feats = settle(_features(docs, carry)).withColumn(
        "base_failed",
        (F.col("n_words") < rules.min_words)
        | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
    )
    # The sketches are small and read three times: they are written once.
    limits = thresholds(settle(sketch(feats.filter(~F.col("base_failed")))), rules)
    limits = limits.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{side}_{m}") for m in METRICS for side in ("low", "high")]
    )
    limits = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1))))
    row = F.pmod(F.monotonically_increasing_id(), F.lit(rules.salts)).cast("int")  # rows that are alike are dealt out, too
    joined = feats.withColumn("salt", row).join(limits, ["lang", "source", "salt"], "left")
    good = ~F.col("base_failed")
    for m, e in METRICS.items():
        value = F.when(~F.col("base_failed"), F.expr(e))
        good = good & F.coalesce(value <= F.col(f"high_{m}"), F.lit(True)) & F.coalesce(value >= F.col(f"low_{m}"), F.lit(True))
    return joined.select("own", *FEATURES, "base_failed", good.alias("kept"))


def judge(docs: DataFrame, rules: Rules = Rules(), carry: list[str] | None = None) -> DataFrame:
    """docs (the columns in carry, or all) with FEATURES, base_failed and kept."""
    carry = docs.columns if carry is None else carry
    return _with(_judged(docs, rules, carry), carry, [*FEATURES, "base_failed", "kept"])


def quality_filter(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their own columns."""
    return _judged(docs, rules, docs.columns).filter("kept").select("own.*")


def op9_quality_rules(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _oracle() -> str:
    r = Rules()
    metric = {m: e.replace(" div ", " // ") for m, e in METRICS.items()}
    values = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS metric, {e} AS v FROM f WHERE NOT base_failed" for m, e in metric.items())
    def of_metric(values):
        return "CASE metric " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in values.items()) + " END"

    floor, low_at, high_at = of_metric(r.floor), of_metric({m: v[0] for m, v in r.outer.items()}), of_metric({m: v[1] for m, v in r.outer.items()})
    return rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
f0 AS (SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
       FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
f AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM f0),
v0 AS ({values}),
v AS (SELECT doc_id, lang, source, metric, v, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS b FROM v0),
lv AS (SELECT 0 AS level, lang AS l, source AS s, metric, b FROM v UNION ALL SELECT 1, lang, '', metric, b FROM v UNION ALL SELECT 2, '', '', metric, b FROM v),
h AS (SELECT level, l, s, metric, b, count(*) AS n FROM lv GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY level, l, s, metric ORDER BY b) AS upto, sum(n) OVER (PARTITION BY level, l, s, metric) AS total FROM h),
q AS (SELECT level, l, s, metric, min(total) AS total, min(b) FILTER (20 * upto >= {low_at} * total) AS lo, min(b) FILTER (20 * upto >= 10 * total) AS mid, min(b) FILTER (20 * upto >= {high_at} * total) AS hi FROM c GROUP BY ALL),
fence AS (SELECT level, l, s, metric, total, CASE WHEN {low_at} > 0 THEN lo - {r.reach} * greatest(mid - lo, {floor}) END AS low, hi + {r.reach} * greatest(hi - mid, {floor}) AS high FROM q),
own AS (SELECT v.doc_id, min_by(v.v <= fence.high AND coalesce(v.v >= fence.low, true), level) AS ok
        FROM v JOIN fence ON fence.metric = v.metric AND ((level = 0 AND l = lang AND s = source) OR (level = 1 AND l = lang) OR level = 2)
        WHERE total >= {r.min_docs} OR level = 2 GROUP BY v.doc_id, v.metric),
ok AS (SELECT doc_id, bool_and(ok) AS ok FROM own GROUP BY doc_id)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, true) AS kept
FROM f LEFT JOIN ok ON ok.doc_id = f.doc_id"""


QUERIES, ORACLES = {"op9_quality_rules": op9_quality_rules}, {"op9_quality_rules": _oracle()}
