"""Barcode tags: validation, demultiplexing and primer sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators import graph


def unique_names(tags: DataFrame) -> DataFrame:
    """tags(id, name): a name that several rows have gets their running number."""
    by = W.partitionBy("name")
    n = F.count("*").over(by)
    number = F.row_number().over(by.orderBy("id"))
    return tags.withColumn("unique_name", F.when(n > 1, F.concat_ws("_", "name", number)).otherwise(F.col("name")))


def swapped_pairs(tags: DataFrame) -> DataFrame:
    """(pair, n_samples, samples) of unordered tag pairs that several samples use; tags(sample, tag1, tag2)."""
    pairs = tags.select(S.pair_key(F.col("tag1"), F.col("tag2")).alias("pair"), "sample")
    out = pairs.groupBy("pair").agg(F.array_sort(F.collect_set("sample")).alias("s"))
    return out.filter(F.size("s") > 1).select("pair", F.size("s").cast("long").alias("n_samples"), F.array_join("s", ", ").alias("samples"))


def unknown_combinations(tags: DataFrame) -> DataFrame:
    """(tag1, tag2) of all combinations of used tags that no sample has. The product is of distinct tags: it is the result."""
    first, second = tags.select("tag1").distinct(), tags.select("tag2").distinct()
    return first.crossJoin(second).join(tags.select("tag1", "tag2").distinct(), ["tag1", "tag2"], "left_anti")


def barcode_ids(tags: DataFrame, width: int = 4) -> DataFrame:
    """(seq, id) of the distinct tag sequences, numbered in order with leading zeros. Tags are few."""
    distinct = tags.select("seq").distinct()
    return distinct.withColumn("id", F.concat(F.lit("bc"), F.lpad(F.row_number().over(W.orderBy("seq")).cast("string"), width, "0")))


def find_sites(reads: DataFrame, primers: DataFrame, length: int, mismatches: int = 2) -> DataFrame:
    """(id, strand, start, end, errors): where a primer of one length lies in reads(id, seq), in either direction. Reads that
    share an id have one row for each place between them."""
    both = primers.select("primer", F.lit("+").alias("strand")).union(primers.select(S.revcomp(F.col("primer")), F.lit("-")))
    places = reads.filter(F.length("seq") >= length).select("id", F.posexplode(S.kmers(F.col("seq"), length)).alias("at", "w"))
    hits = _near(places, both.withColumnRenamed("primer", "tag"), length, mismatches)
    return hits.groupBy("id", "strand", (F.col("at") + 1).alias("start")).agg(F.min("errors").alias("errors")).withColumn("end", F.col("start") + length - 1)


def linked_span(seq: Column, forward: str, reverse: str, mismatches: int = 0, missing: int = 2) -> Column:
    """struct(start, length) of what lies between the primers in a read, from 1; null without both.

    Codes match by the bases that they stand for. Up to ``missing`` bases of a primer may lie beyond the read's ends. A
    primer's site is the first window within the bound.
    """
    k, anti = len(forward), _anti(reverse)
    pad = F.lit("." * missing)

    def site(windows, primer):
        """First window within the bound, from 1; 0 if there is none."""
        return F.array_position(F.transform(windows, lambda w: S.mismatches(w, primer) <= mismatches), True)

    def ends(start):
        # From 1 in the read; the forward primer's site counts the pad.
        return start + k - missing

    def between(begin):
        rest = F.concat(F.substring(seq, begin, F.length(seq)), pad)
        end = site(S.kmers(rest, len(reverse)), anti).cast("int")
        return S.let(end, lambda e: F.when(e > 0, F.struct(begin.alias("start"), (e - 1).alias("length"))))

    first = site(S.kmers(F.concat(pad, seq), k), forward).cast("int")
    return S.let(first, lambda a: F.when(a > 0, S.let(ends(a), between)))


def _anti(primer: str) -> str:
    return primer.translate(str.maketrans(S.COMPLEMENT_FROM, S.COMPLEMENT_TO))[::-1]


def trim(reads: DataFrame, forward: str, reverse: str, mismatches: int = 0, least: int = 10, missing: int = 2) -> DataFrame:
    """reads(seq, qual, ...) with both primers, in the forward direction, sequence and quality cut between them; others are
    dropped. The read itself is tried first, then its reverse complement, whose quality is turned too."""
    def tried(turn: bool, otherwise):
        def of(seq: Column) -> Column:
            given = lambda x: F.when(x.isNotNull(), F.struct(F.lit(turn).alias("turn"), seq.alias("seq"), x["start"].alias("start"), x["length"].alias("length"))).otherwise(otherwise(seq))
            return S.let(linked_span(seq, forward, reverse, mismatches, missing), given)

        return of

    turned = lambda seq: S.let(S.revcomp(seq), tried(True, lambda _: F.lit(None)))
    # Generated, so that conditions on the span aren't pushed into it, which would find it anew at each place where it stands.
    rows = reads.select("*", F.explode(F.array(S.let(F.col("seq"), tried(False, turned)))).alias("_span")).filter(F.col("_span.length") >= least)
    cut = {"seq": F.substring(F.col("_span.seq"), F.col("_span.start"), F.col("_span.length"))}
    if "qual" in reads.columns:
        cut["qual"] = F.substring(F.when(F.col("_span.turn"), F.reverse("qual")).otherwise(F.col("qual")), F.col("_span.start"), F.col("_span.length"))
    return rows.withColumns(cut).drop("_span")


def trim_linked(reads: DataFrame, forward: str, reverse: str, mismatches: int = 0, least: int = 10, missing: int = 0) -> DataFrame:
    """(id, seq) as ``trim`` gives them."""
    return trim(reads.select("id", "seq"), forward, reverse, mismatches, least, missing)


#: Tags, primers or samples up to which they are broadcast; more are joined by a shuffle.
MOST_LISTED = 50_000


def _listed(table: DataFrame) -> DataFrame:
    """The table, for broadcast if a count up to the bound says so; else neither side of its join is: files' sizes say nothing
    of rows that are generated from them."""
    return table.hint("merge") if table.limit(MOST_LISTED + 1).count() > MOST_LISTED else F.broadcast(table)


def _near(windows: DataFrame, listed: DataFrame, length: int, errors: int) -> DataFrame:
    """windows(w, ...) and listed(tag, ...), all of a length, that differ in at most so many bases, with ``errors``.

    A tag is cut into errors + 1 parts, of which one stands unchanged, so they meet on a part.
    """
    cuts = [i * length // (errors + 1) for i in range(errors + 2)]
    parts = lambda c: F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.substring(F.col(c), x + 1, y - x).alias("part")) for i, (x, y) in enumerate(zip(cuts, cuts[1:]))])).alias("p")
    own = [c for c in windows.columns if c != "w"]
    met = windows.select(*own, "w", parts("w")).join(_listed(listed.select("*", parts("tag"))), "p")
    # Those that share several parts are taken at the first.
    same = F.aggregate(F.array(*[F.when((F.substring("w", x + 1, y - x) == F.substring("tag", x + 1, y - x)), i) for i, (x, y) in enumerate(zip(cuts, cuts[1:]))]), F.lit(None).cast("int"), lambda z, i: F.coalesce(z, i))
    near = met.filter(F.col("p.i") == same).withColumn("errors", S.hamming(F.col("w"), F.col("tag"))).filter(F.col("errors") <= errors)
    return near.drop("p", "w")


def _places(ends: DataFrame, barcodes: DataFrame, length: int | None, window: int, errors: int) -> DataFrame:
    """ends(seq, ...) without seq, one row for each place in the first ``window`` bases where a tag of
    barcodes(sample, tag) lies: at, errors, sample, tag. Tags are of ``length``, or of any lengths if that is None."""
    rest = [c for c in ends.columns if c != "seq"]
    lengths = [length] if length is not None else [r.n for r in barcodes.select(F.length("tag").alias("n")).filter("n > 0").distinct().orderBy("n").toLocalIterator()]
    out = None
    for n in lengths or [1]:
        cut = ends.select(*rest, F.posexplode(S.kmers(F.substring("seq", 1, window), n)).alias("at", "w"))
        hits = _near(cut, barcodes.select("sample", "tag").filter(F.length("tag") == n), n, errors).select(*rest, "at", "errors", "sample", "tag")
        out = hits if out is None else out.union(hits)
    return out


def _numbered(reads: DataFrame) -> DataFrame:
    """reads with _row, settled, so that reads that share an id stay apart."""
    return graph.settled(reads.withColumn("_row", F.monotonically_increasing_id()))


def demultiplex(reads: DataFrame, barcodes: DataFrame, length: int | None = None, window: int = 30, errors: int = 1) -> DataFrame:
    """(id, sample, at, errors): the best barcode in a read's first ``window`` bases, or of its reverse complement; fewest
    errors, then earliest, then by name. barcodes(sample, tag) of one length, or of any if it is None. Ids may repeat."""
    rows = _numbered(reads.select("id", "seq"))
    both = rows.select("_row", F.explode(F.array("seq", S.revcomp(F.col("seq")))).alias("seq"))
    best = F.min(F.struct("errors", "at", "sample"))
    found = _places(both, barcodes, length, window, errors).groupBy("_row").agg(best.alias("b"))
    return rows.join(found, "_row").select("id", "b.sample", "b.at", "b.errors")


def demultiplex_pairs(pairs: DataFrame, barcodes: DataFrame, length: int | None = None, window: int = 30, errors: int = 1) -> DataFrame:
    """K3: (id, sample, swapped, r1, r2) of pairs(id, r1, r2): two rounds. A pair belongs to the best barcode in R1; without
    one, to the best in R2, and then the mates change places. What precedes the tag and the tag itself are cut from the mate
    that has it. Pairs with neither are dropped. Tags are of one length, or of any if it is None; ids may repeat."""
    rows = _numbered(pairs.select("id", "r1", "r2"))
    mates = F.array(F.struct(F.lit(False).alias("swapped"), F.col("r1").alias("seq")), F.struct(F.lit(True).alias("swapped"), F.col("r2").alias("seq")))
    ends = rows.select("_row", F.explode(mates).alias("e")).select("_row", "e.*")
    # The first round comes before the second, whatever the errors.
    best = F.min(F.struct("swapped", "errors", "at", "sample", F.length("tag").alias("size"))).alias("b")
    found = _places(ends, barcodes, length, window, errors).groupBy("_row").agg(best)
    tagged = F.when(F.col("b.swapped"), F.col("r2")).otherwise(F.col("r1"))
    other = F.when(F.col("b.swapped"), F.col("r1")).otherwise(F.col("r2"))
    out = rows.join(found, "_row").select("id", "b.sample", "b.swapped", "b.at", "b.size", tagged.alias("tagged"), other.alias("r2"))
    cut = F.substring(F.col("tagged"), F.col("at") + 1 + F.col("size"), F.length("tagged"))
    return out.select("id", "sample", "swapped", cut.alias("r1"), "r2")


def demultiplex_dual(reads: DataFrame, samples: DataFrame, length: int | None = None, window: int = 70, errors: int = 1) -> DataFrame:
    """K1: (id, sample, strand, errors) of reads(id, seq) with a tag at either end; samples(sample, tag1, tag2).

    The best tag at the read's start and that at the start of its reverse complement (fewest errors, then earliest, then by
    sequence) name the sample: tag1 and tag2 in this order '+', the other way round '-'. Equal tags (symmetric) are '+'.
    A read with one tag, or with a combination that no sample has, is dropped. No combination belongs to two samples.
    Tags are compared by mismatches without gaps (``barcodes`` aligns them); they are of one length, or of any if it is None.
    """
    known = samples.select(F.lit(None).cast("string").alias("sample"), F.explode(F.array("tag1", "tag2")).alias("tag")).distinct()
    rows = _numbered(reads.select("id", "seq"))
    sides = F.array(F.struct(F.lit("+").alias("end"), F.col("seq")), F.struct(F.lit("-").alias("end"), S.revcomp(F.col("seq")).alias("seq")))
    ends = rows.select("_row", F.explode(sides).alias("e")).select("_row", "e.*")
    at_end = lambda e: F.min(F.when(F.col("end") == e, F.struct("errors", "at", "tag")))
    best = _places(ends, known, length, window, errors).groupBy("_row").agg(at_end("+").alias("a"), at_end("-").alias("b")).filter("a is not null and b is not null")
    turned = samples.filter("tag1 <> tag2").select("sample", F.lit("-").alias("strand"), F.col("tag2").alias("x"), F.col("tag1").alias("y"))
    named = samples.select("sample", F.lit("+").alias("strand"), F.col("tag1").alias("x"), F.col("tag2").alias("y")).union(turned)
    called = best.select("_row", F.col("a.tag").alias("x"), F.col("b.tag").alias("y"), (F.col("a.errors") + F.col("b.errors")).alias("errors"))
    return called.join(_listed(named), ["x", "y"]).join(rows.select("_row", "id"), "_row").select("id", "sample", "strand", "errors")
