"""Spelling variants: words one edit apart, each grouped under the most frequent form that its chain of forms leads to.

Words are counted in tasks and added up by Spark. The vocabulary is sorted and cut into shards, each a compact trie: chains
of single children are one edge, nodes stand in breadth-first order, so that a node's children are a range, and edges' bytes
are those of the sorted words themselves. Shards are built in tasks and have a bounded number of words and bytes; as many as fit
in BROADCAST_BYTES are broadcast at a time.

There are shards of the words as they are and of the words spelt backwards. A neighbour that first differs in a word's second
half has the first half in common, so it is in the shards whose range holds that beginning, one or two for most words; one
that first differs in the first half is found in the same way by its end. So no word meets every shard, and the automaton
tries errors only far from the roots, where nodes have few children.

A word's Levenshtein automaton of distance one is run through a shard depth-first. A neighbour leaves the word where the
two first differ, so the automaton follows the word without an error, and at each node tries an error into the children
that differ from it (replaced or inserted) and past the word's own letter (deleted); after the error it follows what is
left of the word exactly. So each neighbour is accepted once.

Letters are below U+0100, so a word is handled as Latin-1, one byte each, whose order is that of code points.

Defined cases: a null or empty text has no words; a null doc_id leaves its words as they are; repeated rows count again;
words of any length are taken; an empty table gives no rows; columns other than doc_id and text are dropped. Ties of n go
to the smallest word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import LOWER, UPPER, batches_of, release, settle, table

LETTERS = "[A-Za-zÀ-ÿ]+"
SPOILED, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 300_000
#: Words, and letters, of a shard at most (a longer word is alone); bytes of the shards broadcast at a time.
SHARD_WORDS, SHARD_LETTERS, BROADCAST_BYTES = 100_000, 4_000_000, 32_000_000
#: Words whose neighbours a task looks for, about.
TASK_WORDS = 20_000
_SMALL_LETTERS = re.compile("[a-zÀ-ÿ]+")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return rows

    for batch in batches:
        for part in batches_of(batch, 1, 4_000_000):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if not text:
                    continue
                # Bytes are lower-cased from A to Z alone.
                found = Counter(_SMALL_LETTERS.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if doc is not None:
                    start = zlib.crc32(b"%d:" % doc)
                    for word in [w for w in found if zlib.crc32(w.encode(), start) % SPOILED == 0]:
                        at = zlib.crc32(word.encode(), start) % len(word)
                        n, left = found.pop(word), word[:at] + word[at + 1 :]
                        # A result counts as a result only: it isn't spoiled again.
                        held[left] += n if len(left) >= LEAST_LENGTH else 0
                for word, n in found.items():
                    if len(word) >= LEAST_LENGTH:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
    yield out()
    release()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of docs(doc_id, text): words of LEAST_LENGTH letters and LEAST_COUNT occurrences at least."""
    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


class Trie:
    """A shard's sorted words with their counts. Node j stands for the words from rep[j] on that begin with the first
    depth[j] letters of it, its children are the nodes from first[j] to first[j + 1], label[j] is the first letter that
    it adds to its parent's; a word that ends at a node is rep[j]."""

    __slots__ = ("words", "counts", "label", "first", "rep", "depth")

    def __init__(self, words: list[bytes], counts: list[int]):
        self.words, self.counts = words, counts
        label, first, rep, depth = bytearray(1), array("I"), array("I"), array("I")
        ranges = [(0, len(words))]
        for low, high in ranges:  # grows
            first.append(len(ranges))
            rep.append(low)
            a, b = words[low], words[high - 1]
            if high - low == 1:
                depth.append(len(a))
                continue
            d = _common(a, b, 0)
            depth.append(d)
            at = low + (len(a) == d)
            while at < high:
                letter, start = words[at][d], at
                while at < high and words[at][d] == letter:
                    at += 1
                ranges.append((start, at))
                label.append(letter)
        first.append(len(ranges))
        self.label, self.first, self.rep, self.depth = bytes(label), first, rep, depth

    def packed(self) -> bytes:
        import pickle

        return zlib.compress(pickle.dumps((b"\n".join(self.words), array("q", self.counts), self.label, self.first, self.rep, self.depth)), 1)

    @classmethod
    def unpacked(cls, blob: bytes) -> Trie:
        import pickle

        out = cls.__new__(cls)
        words, counts, out.label, out.first, out.rep, out.depth = pickle.loads(zlib.decompress(blob))
        out.words, out.counts = words.split(b"\n"), counts
        return out

    def _rest(self, j: int, d: int, w: bytes, k: int) -> int:
        """The word that goes through node j and, after its first d letters, is w from k on; -1 if there is none."""
        words, first, rep, depth, label = self.words, self.first, self.rep, self.depth, self.label
        while True:
            s, end = words[rep[j]], depth[j]
            step = k + end - d
            if s[d:end] != w[k:step]:
                return -1
            if step == len(w):
                return rep[j] if len(s) == end else -1
            j = label.find(w[step], first[j], first[j + 1])
            if j < 0:
                return -1
            d, k = end, step

    def near(self, w: bytes, least: int = 0) -> list[int]:
        """Numbers of the words that are one edit from w and share its first ``least`` letters."""
        words, first, rep, depth, label, rest = self.words, self.first, self.rep, self.depth, self.label, self._rest
        out: list[int] = []
        size, i, j = len(w), 0, 0
        while True:
            s, end = words[rep[j]], depth[j]
            if s[i:end] != w[i:end]:  # the word leaves the trie within an edge
                p = _common(s[:end], w, i)
                if p < least:
                    break
                out.append(rest(j, p + 1, w, p))
                if p < size:
                    out += (rest(j, p + 1, w, p + 1), rest(j, p, w, p + 1))
                break
            i, a, b = end, first[j], first[j + 1]
            if i == size:
                out += [rest(c, i + 1, w, i) for c in range(a, b)]
                break
            x = w[i]
            if i < least:
                j = label.find(x, a, b)
                if j < 0:
                    break
                continue
            if len(s) == i and size == i + 1:
                out.append(rep[j])
            y = w[i + 1] if i + 1 < size else -1
            for c in range(a, b):
                if label[c] == x:
                    continue
                t, below = words[rep[c]], depth[c]
                if first[c] == first[c + 1]:
                    left = len(t) - size
                    if (left == 0 and t[i + 1 :] == w[i + 1 :]) or (left == 1 and t[i + 1 :] == w[i:]):
                        out.append(rep[c])
                elif below > i + 1:  # one letter can follow
                    if t[i + 1] == y:
                        out.append(rest(c, i + 1, w, i + 1))
                    if t[i + 1] == x:
                        out.append(rest(c, i + 1, w, i))
                else:
                    out += (rest(c, i + 1, w, i + 1), rest(c, i + 1, w, i))
            if y >= 0 and y != x and (c := label.find(y, a, b)) >= 0:
                out.append(rest(c, i, w, i + 1))
            j = label.find(x, a, b)
            if j < 0:
                break
        return [r for r in out if r >= 0]


def _common(a: bytes, b: bytes, start: int) -> int:
    """How many letters from the first on a and b share, given that they share ``start``."""
    most = min(len(a), len(b))
    if a[start:most] == b[start:most]:
        return most
    while most - start > 16:  # halves
        half = (start + most) // 2
        if a[start:half] == b[start:half]:
            start = half
        else:
            most = half
    while a[start] == b[start]:
        start += 1
    return start


def _shards(most: int):
    """Tries of sorted words (word, n), with their first and last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []
        counts: list[int] = []
        letters = 0

        def row() -> pa.RecordBatch:
            ends = [pa.array([x.decode("latin-1")]) for x in (words[0], words[-1])]
            return pa.RecordBatch.from_arrays([*ends, pa.array([Trie(words, counts).packed()])], ["first", "last", "trie"])

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if words and (len(words) >= most or letters + len(word) > SHARD_LETTERS):
                    yield row()
                    words, counts, letters = [], [], 0
                words.append(word.encode("latin-1"))
                counts.append(n)
                letters += len(word)
        if words:
            yield row()

    return run


class Shards:
    """Shards (first word, last word, packed trie) in order, of words spelt backwards if ``back``. Tries are unpacked when a
    word asks for them."""

    def __init__(self, packed: list[tuple[str, str, bytes]], back: bool):
        self.back, self.packed = back, [t for _, _, t in packed]
        self.first, self.last = ([x[k].encode("latin-1") for x in packed] for k in (0, 1))
        self.tries: list[Trie | None] = [None] * len(packed)

    def near(self, w: bytes) -> list[tuple[int, bytes]]:
        """(-n, word) of w's neighbours that first differ from it in its second half or, if ``back``, in its first. All
        words are spelt as the shards' are."""
        half = len(w) // 2
        # What differs first before ``half`` has all letters after it in common, and so as many at the other end.
        least = len(w) - half if self.back else half
        begin, other = w[:least], w[least:]
        out: list[tuple[int, bytes]] = []
        k = bisect_left(self.last, begin)
        while k < len(self.first) and self.first[k][:least] <= begin:
            if (trie := self.tries[k]) is None:
                trie = self.tries[k] = Trie.unpacked(self.packed[k])
            found = [(-trie.counts[i], trie.words[i]) for i in trie.near(w, least)]
            out += [x for x in found if not x[1].endswith(other)] if self.back else found
            k += 1
        return out


def _neighbours(shared, back: bool):
    """(word, near, best): how many neighbours the shards have of words spelt as theirs, and (n, word) of the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(shared.value, back)
        step = -1 if back else 1
        for batch in batches:
            out: list[tuple] = []
            for word in batch.column(0).to_pylist():
                if found := shards.near(word.encode("latin-1")):
                    m, best = min((m, w[::step]) for m, w in found)
                    out.append((word[::step], len(found), -m, best.decode("latin-1")))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["word", "near", "best_n", "best"])
        del shards
        release()

    return run


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): each round follows the roots found so far, which doubles the steps taken."""
    now = settle(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not now.filter("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = settle(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return now.select("word", "root")


def variants(words: DataFrame, shard_words: int = SHARD_WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of words(word, n): distinct words of letters below U+0100, none empty."""
    spark = words.sparkSession
    words = settle(words.select("word", "n"))
    total = words.count()
    found = None
    for back in (False, True):
        spelt = words.select(F.reverse("word").alias("word"), "n") if back else words
        sorted_words = spelt.repartitionByRange(max(1, -(-total // shard_words)), "word").sortWithinPartitions("word")
        shards = settle(sorted_words.mapInArrow(_shards(shard_words), "first string, last string, trie binary"))
        sizes = shards.select("first", F.octet_length("trie").alias("bytes")).orderBy("first").collect()
        rounds: list[list[str]] = []
        room = 0
        for row in sizes:
            if not rounds or row.bytes > room:
                rounds.append([])
                room = broadcast_bytes
            rounds[-1].append(row["first"])
            room -= row.bytes
        # By ranges, as words with one beginning ask for the same shards.
        dealt = spelt.select("word").repartitionByRange(max(1, -(-total // TASK_WORDS)), "word")
        for names in rounds:
            own = shards.filter(F.col("first").between(names[0], names[-1])).orderBy("first")
            shared = spark.sparkContext.broadcast([(r["first"], r["last"], bytes(r.trie)) for r in own.collect()])
            part = settle(dealt.mapInArrow(_neighbours(shared, back), "word string, near long, best_n long, best string"))
            shared.unpersist()
            found = part if found is None else found.union(part)
    schema = "word string, n long, n_near long, form string, form_n long, root string"
    if found is None:
        return spark.createDataFrame([], schema)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    near = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
    near = near.select(F.col("word").alias("of"), "n_near", (-F.col("b.m")).alias("b_n"), F.col("b.w").alias("b_w"))
    out = words.join(near, words.word == near.of, "left")
    fits = F.col("b_n") >= 2 * F.col("n")
    out = settle(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("b_w")).alias("form"), F.when(fits, F.col("b_n")).alias("form_n")))
    roots = _roots(out.filter("form is not null"))
    return out.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark, sf_dir):
    return variants(vocabulary(table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")


#: Neighbours have one length and are equal but for one place, or one is the other without a letter. crc32 goes bit by bit.
ORACLE = f"""WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS w FROM documents),
    own AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM runs GROUP BY ALL),
    coded AS (SELECT *, flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda c: if(unicode(c) < 128, [unicode(c)], [195, unicode(c) - 64]))) AS bytes FROM own),
    hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(bytes, lambda b: b::BIGINT)), lambda c, b:
        list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: if(x & 1 = 1, xor(x >> 1, 3988292384), x >> 1))), 4294967295) AS h FROM coded),
    spoiled AS (SELECT CASE WHEN h % {SPOILED} = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM hashed),
    words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM spoiled WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
    less AS MATERIALIZED (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)),
    links AS (SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT l.word, w.word FROM less l JOIN words w ON l.rest = w.word UNION SELECT w.word, l.word FROM less l JOIN words w ON l.rest = w.word),
    best AS (SELECT a, count(*) AS n_near, min(struct_pack(m := -n, w := b)) AS top FROM links JOIN words ON b = word GROUP BY a),
    forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -top.m >= 2 * n THEN top.w END AS form, CASE WHEN -top.m >= 2 * n THEN -top.m END AS form_n
        FROM words LEFT JOIN best ON a = word),
    chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
    roots AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


QUERIES, ORACLES = {"op11_spelling_variants": op11_spelling_variants}, {"op11_spelling_variants": ORACLE}
