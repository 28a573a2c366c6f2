"""Secret scanning over an incremental ledger of blobs (DataFrame operations only).

Every version of every text is addressed by the SHA-256 of its content. A ledger holds the findings of each
(blob, rule version) ever scanned; a run scans only the pairs that the ledger lacks, each blob once however many
paths carry it, appends them, and joins findings back to all paths. A ledger is a folder that all executors share, with
a partition for each run; a run is there once its partition is whole, so a repeated or retried run changes nothing.

Positions come from splitting a text at a rule's matches: a match starts at the summed lengths, in code points, of the
pieces and matches before it. So matches are leftmost and non-overlapping per rule, and matches that are too short are
dropped only afterwards, as they still use up their place.

Defined cases: a null text is an empty text and has no findings; repeated rows each get their blob's findings; an empty
table gives an empty result and an empty ledger; very long texts are scanned whole; extra columns of the versions stay
whatever their names, but ``join_back``, which adds ``findings``, replaces a column of that name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sporeline.llm.common import finished, shared_dir, table


@dataclass(frozen=True)
class Rule:
    """pattern must not match the empty text; a match counts if ``group`` (0: all of it) has ``least`` code points."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: The base rules, in the order in which equal starts are listed, then the method's own.
BASE = (
    Rule("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
_PEM_HEADER = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_GAP = r"(?:[\s>\"'+,-]|\\[nr])*+"
#: A key up to its END line, with no other such line between. Without one: its header fields and pieces of 16 and more
#: base64 characters, then a padded piece or a last short line. Line breaks may be written out as \n. All loops are
#: possessive, which Java runs without recursion, so a long key doesn't exhaust the stack.
_PEM = (
    rf"{_PEM_HEADER}(?:[^-]*+(?:-(?!----)[^-]*+)*+-{{5,}}END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_GAP}(?:Proc-Type|DEK-Info): \S*+)*+(?:{_GAP}[A-Za-z0-9+/]{{16,}}+=*+)*+"
    rf"(?:{_GAP}[A-Za-z0-9+/]++=+|(?:\r?\n|\\n)[\x20\t>]*+[A-Za-z0-9+/]++(?=[\x20\t]*+(?:[\r\n\"'\\]|\z)))?+)"
)
ADDED = (
    Rule("pem", _PEM, 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
)
RULES = BASE + ADDED
RULE_VERSION = "2026-11b"


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _matches(order: int, rule: Rule, text: str) -> str:
    """SQL: an array with, for each match, its number and the lengths of the piece before it, of itself and its group."""
    p = _quoted(rule.pattern)
    whole = f"regexp_extract_all({text}, '{p}', 0)"
    part = f"regexp_extract_all({text}, '{p}', {rule.group})" if rule.group else whole
    zipped = f"arrays_zip(split({text}, '{p}', -1), {whole}, {part})"
    item = f"named_struct('ord', {order}, 'i', i, 'before', length(x.`0`), 'own', length(x.`1`), 'part', length(x.`2`))"
    return f"if({text} rlike '{p}', transform({zipped}, (x, i) -> {item}), array())"


def scan(blobs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(blob, ord, kind, start, end) of every finding in blobs(blob, text), positions in code points from 0.

    Only rows of matches are shuffled, for the running sum of the lengths before a match.
    """
    each = "concat(" + ", ".join(_matches(k, r, "text") for k, r in enumerate(rules)) + ")"
    found = blobs.select("blob", F.expr(f"explode_outer({each})").alias("x")).select("blob", "x.*").filter("own is not null")
    upto = W.partitionBy("blob", "ord").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("ord") + 1)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("ord") + 1)
    return (
        found.withColumn("end", F.sum(F.col("before") + F.col("own")).over(upto))
        .filter(F.col("part") >= least)
        .select("blob", "ord", kind.alias("kind"), (F.col("end") - F.col("own")).alias("start"), "end")
    )


SCANNED = "blob string, rule_version string"
FINDINGS = "blob string, ord int, kind string, start long, end long, rule_version string"


def blob_of(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


@dataclass(frozen=True)
class Ledger:
    """What has been scanned and found, in the folder ``path``: one partition of each for a run."""

    spark: SparkSession
    path: str

    def runs(self) -> list[str]:
        """Ids of the runs that are whole; ``scanned`` is written last."""
        return finished(self.spark, f"{self.path}/scanned", "run")

    def _read(self, what: str, schema: str) -> DataFrame:
        parts = [f"{self.path}/{what}/run={r}" for r in self.runs()]
        if parts:
            return self.spark.read.schema(schema).parquet(*parts)
        return self.spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (x.split() for x in schema.split(", "))])

    def scanned(self) -> DataFrame:
        """(blob, rule_version)."""
        return self._read("scanned", SCANNED)

    def findings(self) -> DataFrame:
        """(blob, ord, kind, start, end, rule_version)."""
        return self._read("findings", FINDINGS)

    def scan(self, run: str, versions: DataFrame, rules: tuple = RULES, rule_version: str = RULE_VERSION) -> bool:
        """Scans the blobs of versions(text) that the ledger lacks under this rule version, and appends them; False if the
        run is there already. What an unfinished run left is replaced."""
        if run in self.runs():
            return False
        known = self.scanned().filter(F.col("rule_version") == rule_version).select("blob")
        # Copies meet once: each task passes on one row for each blob that it holds.
        blobs = versions.select(blob_of("text").alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))
        found = scan(blobs.join(known, "blob", "left_anti"), rules)
        found.withColumn("rule_version", F.lit(rule_version)).write.mode("overwrite").parquet(f"{self.path}/findings/run={run}")
        new = versions.select(blob_of("text").alias("blob")).distinct().join(known, "blob", "left_anti")
        new.withColumn("rule_version", F.lit(rule_version)).write.mode("overwrite").parquet(f"{self.path}/scanned/run={run}")
        return True


def _joined(paths: DataFrame, ledger: Ledger, rule_version: str, salts: int) -> DataFrame:
    """own (a struct of the paths' columns, so that no name can clash) with ``findings``, sorted, null where there are none.

    A blob that very many paths share is dealt over ``salts`` tasks; a blob's findings are copied to each.
    """
    found = ledger.findings().filter(F.col("rule_version") == rule_version).groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "ord", "end", "kind"))).alias("findings")
    )
    found = found.select("blob", "findings", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    keyed = paths.select(
        F.struct(*[F.col(f"`{c}`") for c in paths.columns]).alias("own"),
        blob_of("text").alias("blob"),
        F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("salt"),
    )
    return keyed.join(found, ["blob", "salt"], "left").select("own", "findings")


def join_back(paths: DataFrame, ledger: Ledger, rule_version: str = RULE_VERSION, salts: int = 8) -> DataFrame:
    """paths(text, ...) with ``findings``: array<struct<start, ord, end, kind>>, sorted, empty where there are none."""
    empty = F.expr("cast(array() as array<struct<start:bigint,ord:int,end:bigint,kind:string>>)")
    kept = [F.col(f"own.`{c}`").alias(c) for c in paths.columns if c != "findings"]
    return _joined(paths, ledger, rule_version, salts).select(*kept, F.coalesce("findings", empty).alias("findings"))


def _own_ledger(docs: DataFrame, rules: tuple) -> Ledger:
    ledger = Ledger(docs.sparkSession, shared_dir(docs.sparkSession))
    ledger.scan("1", docs, rules)
    return ledger


def find_secrets(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """docs with ``findings``, by way of a new ledger."""
    return join_back(docs, _own_ledger(docs, rules))


#: What stands in place of a secret; no rule matches it.
MASK = "<secret>"


def redact(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """docs with every finding's place in ``text`` taken by MASK and n_chars, if there, counted anew.

    Findings that overlap or touch are masked together; texts without findings stay as they are, nulls included.
    """
    found = _joined(docs, _own_ledger(docs, rules), RULE_VERSION, 8)
    # Start of the gap after each finding is the furthest end so far; the fold carries (furthest end, text so far).
    masked = F.expr(f"""
        aggregate(findings, named_struct('at', 0L, 'out', ''),
            (a, f) -> named_struct(
                'at', greatest(a.at, f.end),
                'out', if(f.start > a.at or a.at = 0, concat(a.out, substring(own.text, cast(a.at + 1 as int), cast(f.start - a.at as int)), '{MASK}'), a.out)),
            a -> concat(a.out, substring(own.text, cast(a.at + 1 as int))))""")
    text = F.when(F.col("findings").isNotNull(), masked).otherwise(F.col("own.text"))
    out = found.select("own", "findings", F.inline(F.array(F.struct(text.alias("new")))))
    new = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        own = F.col("own.n_chars")
        new["n_chars"] = F.when(F.col("findings").isNotNull(), F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(own)
    return out.select(*[new.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns])


def _digest(findings: str) -> str:
    return f"array_join(transform({findings}, f -> concat(f.kind, ':', f.start, ':', f.end)), ',')"


def op10_secret_ledger(spark, sf_dir):
    """Two runs on one ledger: the documents with an odd id, as if they had come first, then all; the second scans only
    what the first hasn't seen. Findings are joined back to all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = Ledger(spark, shared_dir(spark))
    ledger.scan("1", docs.filter("doc_id % 2 = 1"))
    ledger.scan("2", docs)
    found = join_back(docs, ledger)
    n = [F.expr(f"cast(size(filter(findings, f -> f.ord = {k})) as bigint)").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    base = F.expr(_digest(f"filter(findings, f -> f.ord < {len(BASE)})"))
    return found.select("doc_id", *n, F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.expr(_digest("findings")).alias("spans"))


def _oracle() -> str:
    parts = []
    for k, r in enumerate(RULES):
        # The SQL's regular expressions have no possessive loops: it knows of a key's header only.
        p = (_PEM_HEADER if r.kind == "pem" else r.pattern).replace("'", "''")
        parts.append(f"""SELECT doc_id, {k} AS ord, '{r.kind}' AS kind, s, s + length(m[i]) AS e FROM (
            SELECT doc_id, m, g, i, (list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::BIGINT AS s
            FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS m, regexp_extract_all(text, '{p}', {r.group}) AS g, string_split_regex(text, '{p}') AS b,
                  unnest(range(1, len(regexp_extract_all(text, '{p}')) + 1)) AS i FROM t)) WHERE length(g[i]) >= {r.least}""")
    row = "kind || ':' || s || ':' || e"
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), x AS ({' UNION ALL '.join(parts)}),
    d AS (SELECT doc_id, {', '.join(f"count(*) FILTER (ord = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))},
        coalesce(string_agg({row}, ',' ORDER BY s, ord, e) FILTER (ord < {len(BASE)}), '') AS b, string_agg({row}, ',' ORDER BY s, ord, e) AS spans FROM x GROUP BY doc_id)
    SELECT t.doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM t LEFT JOIN d ON d.doc_id = t.doc_id"""


QUERIES, ORACLES = {"op10_secret_ledger": op10_secret_ledger}, {"op10_secret_ledger": _oracle()}
