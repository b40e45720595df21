"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are labels; everything else the classifier sees is unlabelled and
may be toxic itself. With the share of toxic texts (the class prior) p, the risk on clean
text is that on unlabelled text less p times that on toxic text. A sample can drive that
difference below zero by fitting the unlabelled texts too well, so where it is negative the
step goes the other way (the non-negative estimator). The classifier is logistic over the
words present in a text and the beginnings of its longer words.

It is fitted on a bounded sample (``POSITIVES`` and ``UNLABELLED`` rows) and on all features
that lie far from chance in it; scoring reads every whole text and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .text import bytes_of, id_and_text, in_batches, words

#: Bounds of the sample the classifier is fitted on.
POSITIVES, UNLABELLED = 8_000, 24_000
#: Words enter the classifier if their counts lie so many standard errors from chance.
LEAST_APART = 5.0
#: So many features, the furthest from chance, bound the class prior.
MOST_TELLING = 10
THRESHOLD = 0.3
#: Bytes of a long word's beginning that make a feature: inflected forms share it.
BEGINNINGS = (5, 6, 7)
SEED = 8
_SLOTS = 1 << 30


def features(text: bytes) -> set[bytes]:
    """A text's distinct words, and how the longer ones begin (marked by a dash behind)."""
    found = set(words(text))
    return found.union(*[{w[:n] + b"-" for w in found if len(w) > n} for n in BEGINNINGS])


@dataclass
class Classifier:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: bytes) -> float:
        weights = self.weights
        if not weights and self.bias == -np.inf:
            return 0.0
        total = self.bias + sum([weights[w] for w in weights.keys() & features(text)])
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def risk(margin: np.ndarray, n: int, prior: float) -> tuple[float, float, np.ndarray]:
    """The risk on toxic texts, that on clean ones, and the slope of what a step minimises.

    The first ``n`` margins are of positive texts, the others of unlabelled ones. A step
    minimises the sum of both risks, or the negative of the second where that is below zero.
    """
    u = len(margin) - n
    chance = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    loss = np.logaddexp(0, margin)  # of calling a row clean that scores so
    toxic = prior * np.logaddexp(0, -margin[:n]).mean()
    clean = loss[n:].mean() - prior * loss[:n].mean()
    slope = np.empty(len(margin))
    if clean >= 0:
        slope[:n] = (prior * (chance[:n] - 1) - prior * chance[:n]) / n
        slope[n:] = chance[n:] / u
    else:
        slope[:n], slope[n:] = prior * chance[:n] / n, -chance[n:] / u
    return toxic, clean, slope


def nonnegative_pu(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float,
    epochs: int = 600, rate: float = 0.05, decay: float = 1e-3,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier over sets of ``size`` features.

    Each step minimises p * R+(positive) + max(0, R-(unlabelled) - p * R-(positive)) with
    the logistic loss; where the second term is negative the step undoes it instead.
    """
    rows = [*positive, *unlabelled]
    counts = np.array([len(r) for r in rows])
    of = np.repeat(np.arange(len(rows)), counts)
    features = np.concatenate(rows) if counts.sum() else np.zeros(0, dtype=np.int64)
    n = len(positive)
    weights, bias = np.zeros(size), np.log(prior / (1 - prior))
    moments = np.zeros((2, size + 1))
    for step in range(1, epochs + 1):
        margin = np.bincount(of, weights[features], len(rows)) + bias
        _, _, slope = risk(margin, n, prior)
        gradient = np.append(np.bincount(features, slope[of], size) + decay * weights, slope.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, float(bias)


def sample(docs: DataFrame, toxic: DataFrame) -> DataFrame:
    """``(positive, words)`` of a bounded sample: rows of ``toxic(doc_id)`` and of all others.

    Which rows are taken depends on a hash of their ids only. A text of the positive part
    may be in the unlabelled part too, as in any corpus.
    """
    ids = toxic.select("doc_id").where("doc_id IS NOT NULL").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(POSITIVES).withColumn("positive", F.lit(True))
    share = min(1.0, UNLABELLED / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(_SLOTS)) < F.lit(int(share * _SLOTS))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = pa.array([sorted(features(t)) for t in bytes_of(batch.column(2))], pa.list_(pa.binary()))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["positive", "unlabelled", "words"])

        return step

    chosen = (
        docs.where("doc_id IS NOT NULL")
        .join(F.broadcast(ids), "doc_id", "left")  # at most POSITIVES ids
        .select(F.coalesce("positive", F.lit(False)).alias("positive"), drawn.alias("unlabelled"), "text")
        .where("positive OR unlabelled")
    )
    return in_batches(chosen, "positive boolean, unlabelled boolean, words array<binary>", start)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None) -> Classifier:
    """Fit on texts ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    Only ``toxic = 1`` marks a text; the class prior is the share of such among the labels,
    or less where the most telling words are rarer among all texts than that share allows.
    ``may_learn`` (of ``doc_id``) says which rows are there at all. Without a toxic text the
    classifier scores everything 0; a table without labels is that case.
    """
    checkpoint_root(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    if may_learn is not None:
        docs, labels = docs.where(may_learn), labels.where(may_learn)
    marked = labels.where("toxic IS NOT NULL").agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("toxic")).first()
    if not marked.toxic:
        return Classifier({}, -np.inf)
    prior = min(0.5, marked.toxic / marked.n)
    rows = sample(docs, labels.where("toxic = 1")).checkpoint()
    n, u = (rows.agg(F.sum(F.col(c).cast("long"))).first()[0] or 0 for c in ("positive", "unlabelled"))
    if not n or not u:
        return Classifier({}, -np.inf)
    counted = (
        rows.select(F.explode("words").alias("word"), "positive")
        .groupBy("word").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
    )
    # toxic texts that hold the word, against what the others let expect, in standard errors
    expected = F.col("u") * n / u
    apart = F.abs(F.col("p") - expected) / F.sqrt(expected + 1)
    # words of a bounded sample: there are no more of them than it holds
    telling = counted.select("word", apart.alias("apart")).where(F.col("apart") >= LEAST_APART).collect()
    vocabulary = [bytes(r.word) for r in sorted(telling, key=lambda r: (-r.apart, bytes(r.word)))]
    places = {w: i for i, w in enumerate(vocabulary)}

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [[places[w] for w in row if w in places] for row in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["positive", "unlabelled", "places"])

        return step

    # Toxic texts among the unlabelled hold the most telling features as often as the confirmed
    # ones do, and others may hold them too: that bounds the prior from above.
    sparse = in_batches(rows, "positive boolean, unlabelled boolean, places array<int>", start).toArrow()
    held = sparse.column("places").combine_chunks()  # as arrays: the driver makes no object for a place
    ends, values = held.offsets.to_numpy(), held.values.to_numpy().astype(np.int64)
    found = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
    positive, unlabelled = (
        [found[i] for i in np.flatnonzero(sparse.column(part).to_numpy(zero_copy_only=False))] for part in ("positive", "unlabelled"))
    told, there = (np.mean([np.any(f < MOST_TELLING) for f in part]) for part in (positive, unlabelled))
    if told:
        prior = min(prior, max(1 / (u + 1), there / told))
    weights, bias = nonnegative_pu(positive, unlabelled, len(vocabulary), prior)
    return Classifier(dict(zip(vocabulary, weights.tolist())), bias)


def toxicity(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every whole text. Null, empty and wordless texts have the score
    of a text without known words. A row a row, rows with equal or null ids too."""
    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = pa.array([classifier.score(t) for t in bytes_of(batch.column(1))], pa.float64())
            return pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "score"])

        return step

    return in_batches(id_and_text(docs, id_col, text_col), "doc_id long, score double", start)


def keep_clean(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they are."""
    place = docs.columns.index(text_col)

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [classifier.score(t) for t in bytes_of(batch.column(place))]
            return batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

        return step

    return in_batches(docs, docs.schema, start)
