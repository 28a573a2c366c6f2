"""Benchmark decontamination by a prefix-filtered set join (DataFrame operations only).

A benchmark item is a set of windows of ``size`` consecutive words (an item of fewer words is one window). A window is
contained in a text only if all its words are there, so for exact containment one word is a necessary prefix: the
window's rarest by occurrences in the whole corpus. The texts' words are joined to these prefix words alone; a match
at position p proposes the window at p minus the word's offset, which must lie within the text (positional and length
bounds). Proposals are few; each is verified word for word against its text.

A window whose rarest word occurs in no text is dropped, as it can't occur.

Defined cases: a null text has no words; a null or wordless item has no windows; repeated rows of documents get the
same figures each; repeated items with one id count once, a null item id isn't listed; empty tables on either side give
zero hits; very long texts are read whole; extra columns, whatever their names, are kept by ``drop_contaminated``, while
``contamination`` replaces those that have a result column's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import LOWER, UPPER, settle, table

#: Entries (windows' places, or items of windows) up to which a table made from the benchmark alone is sent to every
#: executor; some 150 bytes each, so 30 MB at most.
BROADCAST_ROWS = 200_000


def lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are. Most words are ASCII, for which lower() does it faster."""
    return F.when(F.octet_length(word) != F.length(word), F.translate(word, UPPER, LOWER)).otherwise(F.lower(word))


def _words(text: str) -> str:
    """SQL: the words of a text before they are lowered."""
    return rf"array_remove(split({text}, '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), '')"


def windows(items: DataFrame, size: int) -> DataFrame:
    """(win, items): each distinct window, its words joined by a space, and the ids of the items that have it."""
    words = F.transform(F.expr(_words("text")), lowered)
    each = items.select("item_id", words.alias("w")).filter(F.size("w") > 0)
    many = F.expr(
        f"transform(sequence(1, greatest(size(w) - {size} + 1, 1)), i -> array_join(slice(w, i, {size}), ' '))"
    )
    return each.select("item_id", F.explode(many).alias("win")).groupBy("win").agg(F.collect_set("item_id").alias("items"))


def _small(df: DataFrame, entries: Column | None = None) -> DataFrame:
    """A settled table made from the benchmark alone, to be broadcast if it has been counted to have few entries;
    otherwise Spark joins by a shuffle and splits skewed keys."""
    n = df.agg(F.count("*") if entries is None else F.coalesce(F.sum(entries + 1), F.lit(0))).first()[0]
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def prefixes(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(word, at): each window's rarest word in docs, and the windows it stands for: array<struct<off, win>>.

    wins is a settled table. One pass over docs counts the benchmark's words.
    """
    of = wins.select("win", F.posexplode(F.split("win", " ")).alias("off", "word"))
    known = settle(of.select("word").distinct())
    known = _small(known)
    seen = docs.select(F.explode_outer(F.expr(_words("text"))).alias("w")).select(lowered(F.col("w")).alias("word"))
    counts = settle(seen.join(known, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n")))
    rarest = of.join(counts, "word", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "off")).alias("r")
    )
    return rarest.filter("r.n > 0").groupBy("r.word").agg(F.collect_list(F.struct("r.off", "win")).alias("at"))


def _contamination(docs: DataFrame, items: DataFrame, size: int, counted: bool) -> DataFrame:
    """own (a struct of docs' columns, so that no name can clash) with the RESULT columns; n_words only if counted, else
    only texts with a proposed window are split again."""
    wins = settle(windows(items, size))
    pre = settle(prefixes(docs, wins))
    pre = _small(pre, F.size("at"))
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    # Every word of every text, with its place; only those that are some window's prefix go on.
    # The words are made once per text, before they are dealt out: Spark evaluates what stands beside a generator per row.
    split = docs.select(F.col("doc_id").alias("id"), key.alias("key"), F.expr(_words("text")).alias("w"))
    words = split.select("id", "key", F.size("w").alias("n"), "w").select("id", "key", "n", F.posexplode_outer("w").alias("pos", "w"))
    words = words.select("id", "key", "n", "pos", lowered(F.col("w")).alias("word"))
    proposed = (
        words.join(pre, "word")
        .select("id", "key", "n", "pos", F.explode("at").alias("a"))
        .select("id", "key", "n", (F.col("pos") - F.col("a.off")).alias("start"), "a.win")
        .filter("start >= 0 and start + size(split(win, ' ')) <= n")
    )
    proposed = settle(
        proposed.join(_small(wins, F.size("items")), "win")
        .groupBy("id", "key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "win", "items"))).alias("c"))
    )
    # What is proposed grows with the corpus, so this join shuffles (Spark itself may still broadcast a small table).
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), F.col("doc_id").alias("of"), key.alias("of_key"))
    out = rows.join(proposed, F.col("of").eqNullSafe(F.col("id")) & (F.col("of_key") == F.col("key")), "left")
    again = F.expr(_words("own.text")) if counted else F.when(F.col("c").isNotNull(), F.expr(_words("own.text")))
    # As a generator's row the words are made once per text; a lambda below would else hold the whole expression.
    out = out.select("own", "c", F.inline(F.array(F.struct(again.alias("w")))))

    # Only the words at a proposed place are lowered.
    def verified(c: Column) -> Column:
        at = F.slice("w", c["start"] + 1, F.size(F.split(c["win"], " ")))
        return F.array_join(F.transform(at, lowered), " ") == c["win"]

    out = out.withColumn("hit", F.coalesce(F.filter("c", verified), F.array()))
    covered = """aggregate(hit, named_struct('upto', 0, 'n', 0L),
        (a, c) -> named_struct('upto', greatest(a.upto, c.start + size(split(c.win, ' '))),
            'n', a.n + greatest(0, c.start + size(split(c.win, ' ')) - greatest(a.upto, c.start))),
        a -> a.n)"""
    out = out.withColumn("item_ids", F.expr("array_sort(array_distinct(transform(flatten(transform(hit, c -> c.items)), x -> cast(x as string))))"))
    out = out.select(
        "own",
        F.coalesce(F.size("w"), F.lit(0)).cast("long").alias("n_words"),
        F.expr(covered).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
    )
    # As in quality._features: what is filtered later stays above the generator.
    return out.select("own", "n_words", "n_items", "item_ids", F.inline(F.array(F.struct("n_hit", (F.col("n_hit") > 0).alias("contaminated")))))


RESULT = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """docs with n_words, n_hit, n_items (long), item_ids (array of strings, sorted) and contaminated."""
    found = _contamination(docs, items, size, True)
    return found.select(*[F.col(f"own.`{c}`").alias(c) for c in docs.columns if c not in RESULT], *RESULT)


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The documents without a hit, with their own columns."""
    return _contamination(docs, items, size, False).filter(~F.col("contaminated")).select("own.*")


def op5_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    ids = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, array_to_string(w[i:i+least(len(w), 10)-1], ' ') AS win, least(len(w), 10) AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i+k-1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON bw.win = dw.win),
p AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS x FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(item_id) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""

QUERIES, ORACLES = {"op5_decontaminate": op5_decontaminate}, {"op5_decontaminate": ORACLE}
