"""Sequences, qualities and headers as column expressions. All stay in the JVM."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements and expansions of the nucleotide codes.
COMPLEMENT_FROM = "ATGCUatgcuNnYyRrSsWwKkMmBbDdHhVv"
COMPLEMENT_TO = "TACGAtacgaNnRrYySsWwMmKkVvHhDdBb"
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT", "I": "ACGT",
}


def seq_id(seq: Column) -> Column:
    """SHA-1 of the upper-cased sequence."""
    return F.sha1(F.upper(seq))


def revcomp(seq: Column) -> Column:
    """Reverse complement, ambiguity codes included; other characters stay."""
    return F.reverse(F.translate(seq, COMPLEMENT_FROM, COMPLEMENT_TO))


def canonical(seq: Column) -> Column:
    """The lesser of a sequence and its reverse complement: one key for both strands."""
    return F.least(seq, revcomp(seq))


def homopolymer_collapse(seq: Column) -> Column:
    """Runs of one of A, C, G, T, N become a single base (case-sensitive)."""
    return F.regexp_replace(seq, r"([ACGTN])\1+", "$1")


def homopolymer_cap(seq: Column, longest: int) -> Column:
    """Runs of any character are cut to ``longest`` (1 at least)."""
    h = max(1, int(longest))
    return F.regexp_replace(seq, rf"((.)\2{{{h - 1}}})\2+", "$1")


def has_homopolymer(seq: Column, run: int) -> Column:
    """Whether some base runs for ``run`` or more, in either case."""
    return F.upper(seq).rlike("|".join(f"{b}{{{run}}}" for b in "ACGT"))


def iupac_regex(primer: Column) -> Column:
    """Ambiguity codes as character classes, for matching."""
    out = primer
    # Codes are marked first so that a class's own letters aren't replaced again.
    for code in IUPAC:
        if len(IUPAC[code]) > 1:
            out = F.regexp_replace(out, code, f"<{ord(code)}>")
    for code, bases in IUPAC.items():
        if len(bases) > 1:
            out = F.regexp_replace(out, f"<{ord(code)}>", f"[{bases}]")
    return out


def iupac_expand(primer: str) -> Iterator[str]:
    """All concrete sequences of a primer; for short primers on the driver."""
    return map("".join, itertools.product(*(IUPAC[c] for c in primer.upper())))


def _extend(bases: Column):
    return lambda p: F.transform(bases, lambda x: F.concat(p, x))


def let(value: Column, body) -> Column:
    """body(value) with the value evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def iupac_variants(primer: Column, length: int) -> Column:
    """All concrete sequences of a primer of a known length, as an array."""
    table = F.create_map(*[F.lit(x) for k, v in IUPAC.items() for x in (k, v)])
    out = F.array(F.lit(""))
    for k in range(1, length + 1):
        bases = F.split(table[F.substring(primer, k, 1)], "")
        out = F.flatten(F.transform(out, _extend(bases)))
    return out


def phred(qual: Column, offset: int = 33) -> Column:
    """A quality string as an array of scores."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - offset)


def expected_errors(qual: Column) -> Column:
    """The sum of error probabilities 10 ** (-Q / 10), in string order."""
    return F.aggregate(phred(qual), F.lit(0.0), lambda a, q: a + F.pow(F.lit(10.0), -q / F.lit(10.0)))


def mean_phred(qual: Column) -> Column:
    """Arithmetic mean of the scores; null for an empty string."""
    q = phred(qual)
    return F.when(F.length(qual) > 0, F.aggregate(q, F.lit(0), lambda a, x: a + x) / F.length(qual))


def meep(max_ee: Column, length: Column) -> Column:
    """Expected errors per hundred bases."""
    return F.try_divide(F.lit(100.0) * max_ee, length)


def n_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.translate(F.upper(seq), "N", ""))


def pure_acgt(seq: Column) -> Column:
    """Only A, C, G, T in capitals; the empty sequence counts."""
    return seq.rlike("^[ACGT]*$")


def header_id(header: Column) -> Column:
    return F.regexp_replace(header, ";size=.*$", "")


def header_size(header: Column) -> Column:
    """The size annotation as int; null where there is none."""
    return F.regexp_extract(header, ";size=([0-9]+)", 1).try_cast("int")


def uncross(x: Column, total: Column, n_samples: Column, f: float, p: float) -> Column:
    """Cross-talk score 2 / (1 + exp(x / z) ** p) with z = f * total / n."""
    z = F.lit(f) * total / n_samples
    return F.lit(2.0) / (F.lit(1.0) + F.pow(F.exp(x / z), F.lit(p)))


def hamming(a: Column, b: Column) -> Column:
    """Differing positions of two strings of one length."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, d: s + d)


def mismatches(window: Column, primer: str) -> Column:
    """Positions at which a window of the primer's length has a base that the primer's code doesn't allow; '.' in the
    window (beyond a read's end) is always allowed, and N only where the primer has it."""
    allowed = [IUPAC[c] + ("N." if c in "NI" else ".") for c in primer.upper()]
    codes = F.array(*[F.lit(x) for x in allowed])
    return F.aggregate(F.zip_with(codes, F.split(window, ""), lambda a, x: (F.instr(a, x) == 0).cast("int")), F.lit(0), lambda s, d: s + d)


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order, as an array; empty for shorter sequences."""
    return F.when(
        F.length(seq) >= k,
        F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), lambda i: F.substring(seq, i, F.lit(k))),
    ).otherwise(F.array().cast("array<string>"))


def join_pair(r1: Column, r2: Column, pad: str = "N" * 8) -> Column:
    """R1, a pad and the reverse complement of R2."""
    return F.concat(r1, F.lit(pad), revcomp(r2))


def join_quality(q1: Column, q2: Column, pad: str = "I" * 8) -> Column:
    return F.concat(q1, F.lit(pad), F.reverse(q2))


def _plain_letters() -> tuple[dict[str, str], dict[str, str]]:
    """Latin letters up to U+017F and what they are without marks: one letter for one, and those that become two."""
    import unicodedata

    #: Letters that aren't another one with a mark.
    one = dict(zip("ØøĐđŁłĦħŊŋıſ", "OoDdLlHhNnis"))
    two = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th"}
    for c in map(chr, range(0xC0, 0x180)):
        base = unicodedata.normalize("NFKD", c)[0]
        if base != c and base.isascii() and base.isalpha():
            one[c] = base
    return one, two


def plain(text: Column) -> Column:
    """Latin letters without their marks."""
    one, two = _plain_letters()
    for c, letters in two.items():
        text = F.replace(text, F.lit(c), F.lit(letters))
    return F.translate(text, "".join(one), "".join(one.values()))


def safe_name(name: Column) -> Column:
    """A sample name of letters, digits and underscores: trimmed, marks taken off letters, runs squeezed, only the first '__'
    kept."""
    s = F.regexp_replace(plain(F.trim(name)), r"\s+", " ")
    head = F.substring_index(s, "__", 1)
    tail = F.when(F.instr(s, "__") > 0, F.substring(s, F.instr(s, "__") + 2, F.length(s)))
    clean = lambda x: F.regexp_replace(F.regexp_replace(x, "[^A-Za-z0-9]", "_"), "_+", "_")
    return F.when(tail.isNull(), clean(s)).otherwise(F.concat(clean(head), F.lit("__"), clean(tail)))


def pair_key(a: Column, b: Column) -> Column:
    """One key for an unordered pair."""
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))
