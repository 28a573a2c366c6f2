"""Small relational rules of the workflows: orders with their null placement, referential checks, lookups, set rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators.ranks import running


def by_abundance(rows: DataFrame) -> DataFrame:
    """O1: the most abundant first, then the best quality, then by id; unknown quality last."""
    return rows.orderBy(F.col("Abundance").desc_nulls_last(), F.col("PhredScore").desc_nulls_last(), "SeqID")


def by_size(seqs: DataFrame) -> DataFrame:
    """By falling size, then id; missing last."""
    return seqs.orderBy(F.col("size").desc_nulls_last(), F.col("id").asc_nulls_last())


def by_sample(cells: DataFrame) -> DataFrame:
    """By sample, missing first, then falling abundance, then OTU."""
    return cells.orderBy(F.col("SampleID").asc_nulls_first(), F.desc("Abundance"), "OTU")


def in_buckets(members: DataFrame) -> DataFrame:
    """members(BucketID, size, SeqIndex) with each bucket in one task, by falling size, then index."""
    return members.repartition("BucketID").sortWithinPartitions("BucketID", F.desc("size"), "SeqIndex")


def bucket_bounds(members: DataFrame) -> DataFrame:
    """(BucketID, first, last): the global places of each bucket's first and last member in the order of O4.

    Buckets' sizes, one row each, are summed before them; no member is sorted for it.
    """
    sizes = members.groupBy("BucketID").agg(F.count("*").alias("n"))
    last = F.sum("n").over(W.orderBy("BucketID"))
    return sizes.select("BucketID", (last - F.col("n") + 1).alias("first"), last.alias("last"))


def merge_buckets(parts: list[DataFrame]) -> DataFrame:
    """The members of all buckets' tables (id, size, ...) by falling size, then id."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return by_size(out)


def ranks(totals: DataFrame) -> DataFrame:
    """totals(OTU, total) with rank 1, 2, ... by falling total, then OTU."""
    out = running(totals.select("OTU", "total"), [F.col("total").desc_nulls_last(), F.asc("OTU")], F.lit(1).cast("long"))
    return out.select("OTU", "total", (F.col("before") + 1).alias("rank"))


def ranked_export(sequences: DataFrame, rank: DataFrame) -> DataFrame:
    """SNK6, J17: (rank, record): a FASTA record for each ranked OTU of sequences(SeqID, Abundance, Sequence), in order."""
    own = sequences.join(rank.select(F.col("OTU").alias("SeqID"), "rank"), "SeqID")
    record = F.concat(F.lit(">"), "SeqID", F.lit(";size="), F.col("Abundance").cast("string"), F.lit("\n"), "Sequence")
    return own.select("rank", record.alias("record")).orderBy("rank")


def recovered_reads(rows: DataFrame, sequences: DataFrame) -> DataFrame:
    """One row: rows and reads of rows(Sequence, Abundance) whose sequence is in sequences(Sequence)."""
    own = rows.join(sequences.select("Sequence"), "Sequence", "left_semi")
    return own.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("Abundance"), F.lit(0)).alias("n_reads"))


def lookup(rows: DataFrame, key: str, table: DataFrame, table_key: str, value: str, as_: str) -> DataFrame:
    """Rows with ``as_``, the table's value for the key, whose column has another name there; null if none.
    The table has a key once."""
    side = table.select(F.col(table_key).alias("_lookup_key"), F.col(value).alias(as_))
    return rows.join(side, F.col(key) == F.col("_lookup_key"), "left").drop("_lookup_key")


def lookup_in_order(rows: DataFrame, key: str, table: DataFrame, table_key: str, value: str, as_: str, index: str) -> DataFrame:
    """As lookup, in the order of the rows' index."""
    return lookup(rows, key, table, table_key, value, as_).orderBy(index)


def missing(ids: DataFrame, known: DataFrame, key: str, examples: int = 5) -> tuple[int, list]:
    """How many ids are not known, and the first few of them (a report of that length)."""
    gone = ids.select(key).distinct().join(known.select(key), key, "left_anti")
    return gone.count(), [r[0] for r in gone.orderBy(key).limit(examples).collect()]


def require_known(ids: DataFrame, known: DataFrame, key: str) -> None:
    """An error that lists five ids if any is not known."""
    n, some = missing(ids, known, key)
    if n:
        raise ValueError(f"{n} of {key} not found, such as {', '.join(map(str, some))}")


def require_unique(rows: DataFrame, key: str) -> DataFrame:
    """SNK10: rows, or an error if the key isn't unique or is null, as for a table with a primary key."""
    bad = rows.groupBy(key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col(key).isNull())
    some = [r[0] for r in bad.orderBy(key).limit(5).collect()]
    if some:
        raise ValueError(f"{key} isn't a key: {some}")
    return rows


def first_of_each(tables: list[DataFrame], key: str) -> DataFrame:
    """The rows of all tables, of each key that of the first table that has it, then the least row."""
    rest = [c for c in tables[0].columns if c != key]
    parts = [t.select(key, F.lit(i).alias("table"), *rest) for i, t in enumerate(tables)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(key).agg(F.min(F.struct("table", *rest)).alias("r")).select(key, *[f"r.{c}" for c in rest])


def keep_borderline(scored: DataFrame, chimera: float, clean: float) -> DataFrame:
    """Non-chimeras and borderline sequences of scored(score): all but those whose score reaches ``chimera``; with a
    verdict 'borderline' between the bounds."""
    verdict = F.when(F.col("score") >= clean, "borderline").otherwise("clean")
    return scored.filter((F.col("score") < chimera) | F.col("score").isNull()).withColumn("verdict", verdict)


def joined_regions(first: DataFrame, middle: DataFrame, last: DataFrame) -> DataFrame:
    """(id, seq): three regions' sequences (id, seq) end to end, where all are there, without N at either end."""
    a, b, c = (x.select("id", F.col("seq").alias(n)) for x, n in ((first, "a"), (middle, "b"), (last, "c")))
    return a.join(b, "id").join(c, "id").select("id", F.regexp_replace(F.concat("a", "b", "c"), "^[Nn]+|[Nn]+$", "").alias("seq"))


def records_of(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole records whose id is in the list."""
    return records.join(ids.select("id"), "id", "left_semi")


def denoise_summary(inferred: DataFrame) -> DataFrame:
    """One row: sequences and reads that were kept, merged into others or discarded (target null), and the share of
    reads kept or merged in basis points; inferred(id, target, size)."""
    merged, gone = (F.col("target") != F.col("id")), F.col("target").isNull()
    size = lambda c: F.coalesce(F.sum(F.when(c, F.col("size"))), F.lit(0))
    out = inferred.agg(
        F.count("*").alias("n_seqs"), F.coalesce(F.sum("size"), F.lit(0)).alias("n_reads"), F.count_if(merged).alias("merged_seqs"), size(merged).alias("merged_reads"),
        F.count_if(gone).alias("discarded_seqs"), size(gone).alias("discarded_reads"),
    )
    return out.withColumn("kept_bp", F.expr("if(n_reads = 0, 0L, 10000 * (n_reads - discarded_reads) div n_reads)"))


def chimera_totals(rows: DataFrame) -> DataFrame:
    """(SampleID, n_rows, n_reads, chimera_rows, chimera_reads) of rows(SampleID, Abundance, DeNovo_Chimera)."""
    bad = F.col("DeNovo_Chimera")
    return rows.groupBy("SampleID").agg(
        F.count("*").alias("n_rows"), F.sum("Abundance").alias("n_reads"), F.count_if(bad).alias("chimera_rows"),
        F.coalesce(F.sum(F.when(bad, F.col("Abundance"))), F.lit(0)).alias("chimera_reads"),
    )


def non_singletons(derep: DataFrame) -> DataFrame:
    """One row: sequences, those of two reads and more, their share in percent rounded half up to two places, and
    whether they are fewer than ten."""
    out = derep.agg(F.count("*").alias("n_seqs"), F.count_if(F.col("size") >= 2).alias("n_non_singletons"))
    share = F.when(F.col("n_seqs") > 0, F.round(F.expr("100 * n_non_singletons / n_seqs"), 2))
    return out.withColumn("percent", share).withColumn("few", F.col("n_non_singletons") < 10)


def control_kind(name: Column) -> Column:
    """H16: 'positive' or 'negative' for the names of control samples; null for others."""
    return F.when(F.contains(name, F.lit("PosC")), "positive").when(F.contains(name, F.lit("NegC")), "negative")


def capped(derep: DataFrame, cap: int) -> DataFrame:
    """Sequences with at most ``cap`` of their reads each, which then count against a budget (a sampling operator)."""
    return derep.withColumn("size", F.least(F.col("size"), F.lit(cap)))


def grouped(rows: DataFrame, key: str) -> DataFrame:
    """(key, members): each key's other columns as a sorted array of structs. For keys with few members by nature."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("members"))


def or_default(rows: DataFrame, default: DataFrame) -> DataFrame:
    """Rows, or the default where there are none."""
    return default.select(*rows.columns) if rows.isEmpty() else rows


def biosamples(tags: DataFrame, barcodes: DataFrame) -> DataFrame:
    """tags(sample, tag1, tag2) with the barcode ids of both tags, looked up by sequence in barcodes(seq, id), and
    the kind of control that a sample is."""
    out = lookup(tags, "tag1", barcodes, "seq", "id", "id1")
    out = lookup(out, "tag2", barcodes, "seq", "id", "id2")
    return out.select("sample", "id1", "id2", F.concat_ws("--", "id1", "id2").alias("pair"), control_kind(F.col("sample")).alias("control"))


def tag_report(tags: DataFrame) -> DataFrame:
    """(check, n) of tags(sample, tag1, tag2): samples that share a name or a tag pair, tags with other characters than
    the nucleotide codes, and tags of another length than most. Checks without findings have n 0."""
    both = tags.select(F.explode(F.array("tag1", "tag2")).alias("tag"))
    often = both.groupBy(F.length("tag").alias("l")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", (-F.col("l")).alias("l")))["l"].alias("l"))
    odd = both.join(F.broadcast(often), F.length("tag") != -F.col("l"), "left_semi")
    name = tags.groupBy("sample").agg(F.count("*").alias("n")).filter("n > 1")
    pair = tags.groupBy("tag1", "tag2").agg(F.count("*").alias("n")).filter("n > 1")
    bad = both.filter(~F.upper("tag").rlike("^[ACGTURYSWKMBDHVNI]+$"))
    parts = [("repeated_name", name), ("repeated_pair", pair), ("odd_characters", bad), ("odd_length", odd)]
    out = None
    for label, found in parts:
        one = found.agg(F.lit(label).alias("check"), F.count("*").alias("n"))
        out = one if out is None else out.union(one)
    return out


def by_meep(reads: DataFrame) -> DataFrame:
    """reads(id, seq, qual, ...) by rising share of expected errors, then id; those without qualities last."""
    share = S.meep(S.expected_errors(F.col("qual")), F.length("qual"))
    return reads.orderBy(share.asc_nulls_last(), F.col("id").asc_nulls_last())


def best_reads(reads: DataFrame) -> DataFrame:
    """O8 with D19: (seq, size, id, meep): reads(id, seq, qual) dereplicated, each sequence by its read of the least share of
    expected errors, then the least id. An aggregate stands for the sort before dereplication."""
    share = S.meep(S.expected_errors(F.col("qual")), F.length("qual")).alias("meep")
    rows = reads.select("seq", "id", share, share.isNull().alias("unknown"))
    best = F.min(F.struct("unknown", "meep", "id")).alias("b")
    return rows.groupBy("seq").agg(F.count("*").alias("size"), best).select("seq", "size", "b.id", "b.meep")


#: Checks of tags that make a run senseless; the others are warnings.
ERRORS = ("repeated_name", "repeated_pair", "odd_characters", "no_tag")


def tag_findings(tags: DataFrame) -> DataFrame:
    """(severity, check, sample, detail) of tags(sample, tag1, tag2), tag2 null where there is one tag: a row for each sample
    that shares its cleaned name or its tags with another, has no tag or one with other characters than nucleotide codes
    (errors), has a tag of another length than most or a name that is changed by cleaning (warnings), and a row each for
    a missing positive and negative control (warnings, sample null)."""
    clean = S.safe_name(F.col("sample"))
    rows = tags.select("sample", F.upper("tag1").alias("tag1"), F.upper("tag2").alias("tag2"), clean.alias("name"))
    each = rows.select("sample", F.explode(F.array("tag1", "tag2")).alias("tag")).filter("tag <> ''")
    counts = each.groupBy(F.length("tag").alias("l")).agg(F.count("*").alias("n"))
    usual = counts.agg(F.max(F.struct("n", (-F.col("l")).alias("l")))["l"].alias("l"))
    shared = lambda *keys: rows.join(rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_n")).filter("_n > 1"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    row = lambda df, check, detail: df.select(F.lit("error" if check in ERRORS else "warning").alias("severity"), F.lit(check).alias("check"), "sample", detail.alias("detail"))
    pair = F.concat_ws("--", "tag1", "tag2")
    parts = [
        row(shared("name"), "repeated_name", F.col("name")), row(shared("tag1", "tag2").filter("tag1 <> ''"), "repeated_pair", pair),
        row(each.filter(~F.col("tag").rlike("^[ACGTURYSWKMBDHVNI]+$")), "odd_characters", F.col("tag")),
        row(rows.filter("coalesce(tag1, '') = ''"), "no_tag", F.lit("")),
        row(each.join(F.broadcast(usual), F.length("tag") != -F.col("l"), "left_semi"), "odd_length", F.col("tag")),
        row(rows.filter("name <> sample"), "renamed", F.col("name")),
    ]
    kinds = rows.agg(*[F.coalesce(F.bool_or(F.col("sample").contains(k)), F.lit(False)).alias(k) for k in ("PosC", "NegC")])
    for k in ("PosC", "NegC"):
        parts.append(row(kinds.filter(~F.col(k)).withColumn("sample", F.lit(None).cast("string")), "no_control", F.lit(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def require_valid(tags: DataFrame) -> DataFrame:
    """tags, or an error that lists the first offenders."""
    bad = tag_findings(tags).filter("severity = 'error'").orderBy("check", "sample", "detail").limit(5).collect()
    if bad:
        raise ValueError("tags: " + "; ".join(f"{r.check}: {r.sample} {r.detail}" for r in bad))
    return tags
