"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, with a block-max inverted index.

Fit: of the labelled training rows a sample of at most ``max_examples`` (those with the least hash of the id) is joined
to its texts. All their words are terms but those in fewer than ``min_df`` examples or in more than ``max_share`` of
them. A term's weight is (1 + ln count) * idf * its worth: the phi coefficient of presence and label where its
chi-square is over ``min_chi2``, else ``least_worth``; so labels weigh terms and leave none out. The next
``max_calibration`` labelled rows by hash are scored by the index and give a logistic curve from votes to scores. The
model is bounded by these parameters, however large the corpus, so it may be sent to every executor.

Score: a text's vector over the terms is compared exactly with all example vectors. The index has a posting list for
each term, in blocks of examples with the block's largest weight; the blocks' bounds are added up over the text's terms,
and blocks are opened in falling order of their bound while that can still reach the k-th best cosine. All examples at
least as near as the k-th vote, with weight cosine ** sharpness, and the vote is drawn towards the share of toxic labels
by ``prior`` votes. The nearest examples' ids come back as evidence.

Defined cases: a null or empty text, or one without any term, has the score of the prior alone; repeated rows score
alike; with no labelled rows, or one label only, all scores are the share of label 1 (0.5 without rows); labels that are
null or neither 0 nor 1 aren't learnt from, of several rows for one id the largest label counts, and of several texts
for one id the first in order; a null doc_id is held out of nothing and never an example; very long texts are read
whole; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sporeline.llm.common import batches_of, fold, settle, table

#: Words: runs of ASCII letters and any bytes of other scripts, after A-Z are lower-cased.
_word = re.compile(rb"[a-z\x80-\xff]+").findall


#: Bytes of texts split at once, about.
BATCH_BYTES = 2_000_000


@dataclass(frozen=True)
class Config:
    max_examples: int = 8_000
    max_calibration: int = 2_000
    min_df: int = 2
    max_share: float = 0.1
    min_chi2: float = 10.83
    least_worth: float = 0.02
    k: int = 25
    sharpness: float = 2.0
    prior: float = 0.1
    block: int = 64
    evidence: int = 3


def words_of(text: str | None) -> list[bytes]:
    return _word((text or "").encode("utf-8", "surrogatepass").lower())


def weights(terms: np.ndarray, counts: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """The unit vector of term counts: (1 + ln count) * worth."""
    raw = (1.0 + np.log(counts)) * worth[terms]
    return raw / np.sqrt((raw * raw).sum())


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one span after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


class Index:
    """Example vectors in posting lists with block maxima. terms, docs, weights: the vectors' entries, in any order.

    Within the index examples stand in the order of their heaviest terms, so those that are alike share blocks: lists have
    fewer blocks, and the bounds of the others are low.
    """

    def __init__(self, terms: np.ndarray, docs: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int, cfg: Config):
        self.cfg, self.n = cfg, n_docs
        tops, rest = [], np.ones(len(docs), bool)
        for _ in range(2):
            most, top = np.zeros(n_docs), np.full(n_docs, -1)
            np.maximum.at(most, docs[rest], weights[rest])
            heaviest = rest & (weights == most[docs])
            np.maximum.at(top, docs[heaviest], terms[heaviest])
            rest &= terms != top[docs]
            tops.append(top)
        #: An example's number by its place, and the reverse.
        self.number = np.lexsort((tops[1], tops[0]))
        place = np.empty(n_docs, np.int64)
        place[self.number] = np.arange(n_docs)
        docs = place[docs]
        order = np.lexsort((docs, terms))
        terms, self.docs, self.weights = terms[order], docs[order].astype(np.int32), weights[order]
        # An entry of the block lists: one term in one block, with its postings' span and their largest weight.
        block = self.docs // cfg.block
        first = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])])[: len(terms)])
        self.at = np.append(first, len(terms)).astype(np.int64)
        self.block = block[first]
        self.peak = np.maximum.reduceat(self.weights, first) if len(first) else self.weights
        self.of_term = np.searchsorted(terms[first], np.arange(n_terms + 1))
        self.blocks = -(-n_docs // cfg.block)

    def nearest(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of all examples at least as near as the k-th nearest, over 0; the nearest first."""
        n = self.of_term[terms + 1] - self.of_term[terms]
        entries, own = _spans(self.of_term[terms], n), np.repeat(weights, n)
        blocks = self.block[entries]
        bound = np.bincount(blocks, own * self.peak[entries], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound > 1e-12)]
        k, at, step, kth = self.cfg.k, 0, 12, 0.0
        docs, cosines = np.zeros(0, np.int64), np.zeros(0)
        while at < len(order):
            some = order[at : at + step]
            some = some[bound[some] >= kth - 1e-9]
            if not len(some):
                break  # this block and those after it can't reach the k-th best
            at, step = at + step, self.blocks  # most texts are settled in two steps, each of which has its cost
            opened = np.zeros(self.blocks, bool)
            opened[some] = True
            use = np.flatnonzero(opened[blocks])
            e = entries[use]
            size = self.at[e + 1] - self.at[e]
            p = _spans(self.at[e], size)
            cos = np.bincount(self.docs[p], np.repeat(own[use], size) * self.weights[p], self.n)
            hit = np.flatnonzero(cos > 1e-12)
            docs, cosines = np.concatenate([docs, hit]), np.concatenate([cosines, cos[hit]])
            if len(cosines) >= k:
                kth = float(np.partition(cosines, len(cosines) - k)[len(cosines) - k])
        keep = cosines >= kth - 1e-9
        docs, cosines = self.number[docs[keep]], cosines[keep]
        order = np.lexsort((docs, -cosines))
        return docs[order], cosines[order]


@dataclass
class Model:
    terms: list[bytes]
    worth: np.ndarray  # idf times the worth of a term
    entries: tuple[np.ndarray, np.ndarray, np.ndarray]  # term, example, weight
    ids: np.ndarray  # of the examples
    toxic: np.ndarray
    share: float
    cfg: Config
    curve: tuple[float, float] | None = None  # slope and offset of the log odds
    sent: Broadcast | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "sent": None, "curve": None}


class Scorer:
    def __init__(self, model: Model):
        self.model, self.cfg = model, model.cfg
        self.number = {t: i for i, t in enumerate(model.terms)}
        terms, docs, w = model.entries
        self.index = Index(terms.astype(np.int64), docs, w.astype(np.float64), len(model.ids), len(model.terms), model.cfg)

    def vote(self, text: str | None) -> tuple[float, list[int]]:
        """The neighbours' share of label 1, and the nearest ones' ids."""
        number, m = self.number, self.model
        own = sorted([(number[w], n) for w, n in Counter(words_of(text)).items() if w in number])
        if not own:
            return m.share, []
        terms, n = np.array(own, np.int64).T
        d, c = self.index.nearest(terms, weights(terms, n.astype(float), m.worth))
        w = c**self.cfg.sharpness
        raw = (float((w * m.toxic[d]).sum()) + self.cfg.prior * m.share) / (float(w.sum()) + self.cfg.prior)
        return min(1.0, max(0.0, raw)), m.ids[d[: self.cfg.evidence]].tolist()


def calibrated(raw: float, curve: tuple[float, float] | None) -> float:
    return raw if curve is None else 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, curve[0] * raw + curve[1]))))


def fit_curve(raw: np.ndarray, label: np.ndarray) -> tuple[float, float] | None:
    """Logistic regression of labels on votes by Newton's method, with a weak pull of the slope towards 8; none for rows of
    one label."""
    if len(raw) < 20 or label.min() == label.max():
        return None
    x, b = np.stack([raw, np.ones(len(raw))], 1), np.array([8.0, -4.0])
    pull, goal = np.diag([0.05, 0.0]), np.array([8.0, 0.0])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull + 1e-9 * np.eye(2), x.T @ (label - p) - pull @ (b - goal))
        b = b + np.clip(step, -5, 5)
        if abs(step).max() < 1e-9:
            break
    return (float(b[0]), float(b[1])) if b[0] > 0 else None


def fit(docs: DataFrame, labels: DataFrame, cfg: Config = Config()) -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, toxic), which the caller has limited to training rows."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # Only ids that are there; the least hashes are the index, the next the calibration.
    there = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = settle(there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.max_examples + cfg.max_calibration))
    n_all = sample.count()
    n = min(cfg.max_examples, n_all - min(cfg.max_calibration, n_all // 5))
    # At most max_examples + max_calibration rows of 20 bytes, so one task ranks them and the broadcast is bounded.
    ranked = sample.withColumn("index", F.row_number().over(W.orderBy(F.xxhash64("doc_id"), "doc_id")) <= n)
    rows = settle(docs.select("doc_id", "text").join(F.broadcast(ranked), "doc_id").groupBy("doc_id", "toxic", "index").agg(F.min("text").alias("text")))
    if not n:
        return Model([], np.zeros(0), (np.zeros(0, np.int64),) * 2 + (np.zeros(0),), np.zeros(0, np.int64), np.zeros(0), 0.5, cfg)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_of(whole, 2, BATCH_BYTES):
                counts = [Counter(words_of(t)) for t in b.column(2).to_pylist()]
                words = pa.array([list(c) for c in counts], pa.list_(pa.binary()))
                times = pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), words, times], ["doc_id", "toxic", "words", "n"])

    schema = "doc_id long, toxic int, words array<binary>, n array<int>"
    seen = settle(rows.filter("index").select(F.col("doc_id").cast("long"), "toxic", "text").mapInArrow(split, schema))
    positive = seen.agg(F.coalesce(F.sum("toxic"), F.lit(0))).first()[0]
    share = positive / n
    by_word = seen.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"), F.sum("toxic").alias("p"))
    # Words of at most max_examples texts.
    words = by_word.filter((F.col("df") >= cfg.min_df) & (F.col("df") <= max(cfg.min_df, cfg.max_share * n))).toArrow().sort_by("word")
    terms = words.column("word").to_pylist()
    df, p = (words.column(c).to_numpy().astype(float) for c in ("df", "p"))
    # 2 x 2 chi-square of presence and label.
    cross = p * (n - positive - (df - p)) - (df - p) * (positive - p)
    below = df * (n - df) * positive * (n - positive)
    chi2 = np.divide(n * cross * cross, below, out=np.zeros(len(df)), where=below > 0)
    worth = (np.log((1 + n) / (1 + df)) + 1.0) * np.where(chi2 >= cfg.min_chi2, np.sqrt(chi2 / n), cfg.least_worth)
    number = {t: i for i, t in enumerate(terms)}
    ids, toxic, entries = [], [], ([], [], [])
    for r in seen.orderBy("doc_id").toLocalIterator():
        own = sorted((number[w], c) for w, c in zip(map(bytes, r.words), r.n) if w in number)
        if own:
            t, c = (np.array(x, np.int64) for x in zip(*own))
            for x, y in zip(entries, (t.astype(np.int32), np.full(len(t), len(ids), np.int32), weights(t, c, worth).astype(np.float32))):
                x.append(y)
        ids.append(r.doc_id)
        toxic.append(r.toxic)
    flat = tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in entries)
    model = Model(terms, worth, flat, np.array(ids), np.array(toxic, float), share, cfg)
    votes = score(rows.filter("not index"), model).join(rows.select("doc_id", "toxic"), "doc_id").select("score", "toxic").toArrow()
    model.curve = fit_curve(votes.column(0).to_numpy(), votes.column(1).to_numpy().astype(float))
    return model


_held: dict[str, Scorer] = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, evidence) of docs(doc_id, text); evidence: ids of the nearest examples."""
    if model.sent is None:
        model.sent = docs.sparkSession.sparkContext.broadcast(model)  # once: it lies on every executor's disk
    sent, curve = model.sent, model.curve
    number = uuid.uuid4().hex  # a worker keeps one model's scorer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if number not in _held:
            _held.clear()
            _held[number] = Scorer(sent.value)
        own = _held[number]
        for b in batches:
            found = [own.vote(t) for t in b.column(1).to_pylist()]
            scores = pa.array([calibrated(raw, curve) for raw, _ in found], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), scores, pa.array([e for _, e in found], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, evidence array<long>")


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id")) != 0)
    found = score(docs, fit(docs, labels))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


QUERIES, ORACLES = {"op3_toxicity": op3_toxicity}, {}
