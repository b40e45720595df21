"""Topic models whose steps go over blocks of documents.

Spark's fit by expectation maximisation makes a graph with objects for every term of a document, and
its bound of the likelihood takes the exponential of the whole topic matrix anew for each document.
Here documents travel in blocks of bounded size, and a step looks only at the terms its block holds.
Formulas, random starts, order of draws and stopping rules are Spark's, so are the models' tables.
What the driver holds are the topics, terms by k, as in Spark's local model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import clustering as ml
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Terms of documents in a block, and numbers (terms by topics) made of them at a time: the memory of a task.
BLOCK, CELLS = 500_000, 4_000_000
PACKED = "part int, first bigint, ids binary, ends binary, places binary, counts binary, terms binary"
#: java.util.Random
MULTIPLIER, ADDEND, STATES = 0x5DEECE66D, 0xB, (1 << 48) - 1

Block = tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class LDA(ml.LDA):
    """``optimizer="em"`` is fitted by blocks, ``"online"`` by Spark; both models bound likelihoods by blocks."""

    def _fit(self, dataset: DataFrame) -> Any:
        if self.getOptimizer().lower() != "em":
            return super()._fit(dataset)
        fitted = _expectation_maximisation(self, dataset)
        model = DistributedLDAModel(_local_java(self.uid, fitted), fitted)
        model._resetUid(self.uid)
        self._copyValues(model)
        model._transfer_params_to_java()
        return model

    def _create_model(self, java_model: Any) -> ml.LDAModel:
        return LocalLDAModel(java_model)


class _Bounded:
    """Likelihoods of documents under a model whose ``_java_obj`` is a local one."""

    def logLikelihood(self, dataset: DataFrame) -> float:
        return self._bound(dataset)[0]

    def logPerplexity(self, dataset: DataFrame) -> float:
        bound, tokens = self._bound(dataset)
        return -bound / tokens if tokens else math.nan

    def _bound(self, dataset: DataFrame) -> tuple[float, float]:
        topics, old = self.topicsMatrix().toArray(), self._java_obj.oldLocalModel()
        alpha = self.estimatedDocConcentration().toArray()
        return _likelihood_bound(dataset, self.getFeaturesCol(), topics, alpha, old.topicConcentration(), old.gammaShape(), old.getSeed())


class LocalLDAModel(_Bounded, ml.LocalLDAModel):
    pass


class DistributedLDAModel(_Bounded, ml.DistributedLDAModel):
    """A fit by expectation maximisation: its documents stay in blocks on the executors."""

    def __init__(self, java_model: Any = None, fitted: _Fitted | None = None):
        super().__init__(java_model)
        self._fitted = fitted

    def isDistributed(self) -> bool:
        return True

    def toLocal(self) -> LocalLDAModel:
        model = LocalLDAModel(_local_java(self.uid, self._fitted))
        model._resetUid(self.uid)
        self._copyValues(model)
        model._transfer_params_to_java()
        return model

    def trainingLogLikelihood(self) -> float:
        return self._fitted.likelihood()

    def logPrior(self) -> float:
        return self._fitted.prior()

    def getCheckpointFiles(self) -> list[str]:
        return list(self._fitted.files)

    def write(self) -> Any:
        """Spark's own writer over Spark's own graph, made of the blocks."""
        java = self._fitted.spark_form(self.uid)
        model = ml.DistributedLDAModel(java)
        model._resetUid(self.uid)
        self._copyValues(model)
        model._transfer_params_to_java()
        return model.write()


class _Fitted:
    def __init__(self, spark: Any, blocks: RDD, state: RDD, counts: np.ndarray, alpha: float, eta: float, files: list[str]):
        self.spark, self.blocks, self.state, self.counts, self.alpha, self.eta, self.files = spark, blocks, state, counts, alpha, eta, files

    def likelihood(self) -> float:
        """Of the training documents: each term's chance under its topics and the document's shares."""
        chances = self.spark.sparkContext.broadcast(_smoothed(self.counts, self.eta))
        alpha1 = self.alpha - 1.0

        def of(pair: tuple[Block, tuple]) -> float:
            block, (shares, _, _) = pair
            _, _, _, ends, places, counts, terms = block
            theta, phi = shares + alpha1, chances.value[terms]
            theta /= theta.sum(axis=1, keepdims=True)
            return sum(
                float(counts[a:b] @ np.log((phi[places[a:b]] * np.repeat(theta[i:j], np.diff(ends[i:j + 1]), axis=0)).sum(axis=1)))
                for i, j, a, b in _pieces(ends, phi.shape[1]))

        return float(self.blocks.zip(self.state).map(of).sum())

    def prior(self) -> float:
        alpha1, eta1 = self.alpha - 1.0, self.eta - 1.0

        def of(state: tuple) -> float:
            theta = state[0] + alpha1
            return float(np.log(theta / theta.sum(axis=1, keepdims=True)).sum()) * alpha1

        # a term that no document holds is no vertex of Spark's graph
        held = _smoothed(self.counts, self.eta)[self.counts.sum(axis=1) > 0]
        return float(self.state.map(of).sum() + eta1 * np.log(held).sum())

    def spark_form(self, uid: str) -> Any:
        """The model as Spark's own object, by way of the files Spark saves it in."""
        from pyspark.mllib.linalg import DenseVector as Weights, VectorUDT

        spark, path = self.spark, scratch_path(self.spark, "topics")
        size, k = self.counts.shape
        told = {
            "class": "org.apache.spark.mllib.clustering.DistributedLDAModel", "version": "1.0", "k": k, "vocabSize": size,
            "docConcentration": [self.alpha] * k, "topicConcentration": self.eta, "iterationTimes": [], "gammaShape": 100.0}
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        vector = lambda name: T.StructType([*([T.StructField("id", T.LongType())] if name == "topicWeights" else []), T.StructField(name, VectorUDT())])
        spark.createDataFrame([(Weights(self.counts.sum(axis=0)),)], vector("globalTopicTotals")).write.parquet(f"{path}/data/globalTopicTotals")
        documents = self.blocks.zip(self.state).flatMap(
            lambda pair: [(int(i), Weights(row)) for i, row in zip(pair[0][2], pair[1][0])])
        terms = self.spark.sparkContext.parallelize(
            [(-1 - int(i), Weights(self.counts[i])) for i in np.flatnonzero(self.counts.sum(axis=1) > 0)])
        spark.createDataFrame(documents.union(terms), vector("topicWeights")).write.parquet(f"{path}/data/topicCounts")

        def edges(block: Block) -> list[tuple]:
            _, _, ids, ends, places, counts, terms = block
            return list(zip(np.repeat(ids, np.diff(ends)).tolist(), (-1 - terms[places].astype(np.int64)).tolist(), counts.tolist()))

        schema = "srcId bigint, dstId bigint, tokenCounts double"
        spark.createDataFrame(self.blocks.flatMap(edges), schema).write.parquet(f"{path}/data/tokenCounts")
        jvm = spark.sparkContext._jvm
        old = jvm.org.apache.spark.mllib.clustering.DistributedLDAModel.load(spark.sparkContext._jsc.sc(), path)
        return jvm.org.apache.spark.ml.clustering.DistributedLDAModel(uid, size, old, spark._jsparkSession, getattr(jvm.scala, "None$").__getattr__("MODULE$"))


def _local_java(uid: str, fitted: _Fitted) -> Any:
    spark, (size, k) = fitted.spark, fitted.counts.shape
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    topics = _py2java(context, DenseMatrix(size, k, fitted.counts.ravel(order="F")))
    alpha = _py2java(context, DenseVector([fitted.alpha] * k))
    older = jvm.org.apache.spark.mllib.linalg
    old = jvm.org.apache.spark.mllib.clustering.LocalLDAModel(
        older.Matrices.fromML(topics), older.Vectors.fromML(alpha), fitted.eta, 100.0)
    return jvm.org.apache.spark.ml.clustering.LocalLDAModel(uid, size, old, spark._jsparkSession)


# blocks --------------------------------------------------------------------------------


def _blocks(df: DataFrame, features: str) -> RDD:
    """Documents with their ids as ``Block``s: the stored terms that are not zero, in their order."""
    value = F.col(features)
    if dict(df.dtypes)[features].startswith("array"):
        value = array_to_vector(value.cast("array<double>"))
    rows = df.select(F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("part"), value.alias("vector"))
    return rows.mapInArrow(_packed, PACKED).rdd.map(_unpacked)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, kept, held, part = 0, [], 0, 0

    def block() -> pa.RecordBatch:
        ids, sizes, terms, counts = (np.concatenate(c) for c in zip(*kept))
        distinct, places = np.unique(terms, return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        row = [ids.astype(np.int64), ends.astype(np.int64), places.astype(np.int32), counts, distinct.astype(np.int32)]
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([first], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in row]],
            [f.split()[0] for f in PACKED.split(", ")])

    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            some = batch.slice(start, 1000)
            vectors = some.column(2)
            if vectors.null_count:
                raise ValueError("a document's vector is null")
            part = some.column(1)[0].as_py()
            for id_, vector in zip(some.column(0).to_numpy(), vectors):
                counts = vector["values"].values.to_numpy(zero_copy_only=False).astype(float)
                terms = vector["indices"].values.to_numpy() if vector["type"].as_py() == 0 else np.arange(len(counts))
                some_terms = counts != 0
                if not some_terms.any():
                    continue
                kept.append(([id_], [int(some_terms.sum())], terms[some_terms], counts[some_terms]))
                held += kept[-1][1][0]
                if held >= BLOCK:
                    yield block()
                    first, kept, held = first + held, [], 0
    if kept:
        yield block()


def _unpacked(row: Any) -> Block:
    kinds = [np.int64, np.int64, np.int32, np.float64, np.int32]
    return (row.part, row.first, *[np.frombuffer(row[2 + i], kind) for i, kind in enumerate(kinds)])


def _pieces(ends: np.ndarray, k: int) -> Iterator[tuple[int, int, int, int]]:
    """(first document, end, first term, end) of runs of documents that make a bounded number of cells."""
    i, most = 0, max(1, CELLS // k)
    while i < len(ends) - 1:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1)
        yield i, j, int(ends[i]), int(ends[j])
        i = j


def _size(df: DataFrame, features: str) -> int:
    first = df.select(features).first()
    if first is None:
        raise ValueError("no documents to learn topics from")
    return len(first[0])


# expectation maximisation --------------------------------------------------------------


def _smoothed(counts: np.ndarray, eta: float) -> np.ndarray:
    return (counts + (eta - 1.0)) / (counts.sum(axis=0) + len(counts) * (eta - 1.0))


def _expectation_maximisation(op: ml.LDA, df: DataFrame) -> _Fitted:
    spark, features, k, seed = df.sparkSession, op.getFeaturesCol(), op.getK(), op.getSeed()
    given = op.isSet(op.docConcentration) and op.getDocConcentration() or [-1.0]
    alpha = given[0] if given[0] != -1 else 50.0 / k + 1.0
    eta = op.getTopicConcentration() if op.isSet(op.topicConcentration) and op.getTopicConcentration() != -1 else 1.1
    if len(set(given)) > 1 or alpha <= 1.0 or eta <= 1.0:
        raise ValueError("a fit by em takes one docConcentration for all topics, and concentrations above 1")
    size, context = _size(df, features), spark.sparkContext
    blocks = _blocks(df, features).persist(StorageLevel.MEMORY_AND_DISK)

    def start(block: Block) -> tuple:
        part, first, _, ends, places, counts, terms = block

        def drawn(a: int, b: int) -> np.ndarray:
            gamma = _draws(part + seed, (first + a) * k, (b - a) * k).reshape(-1, k)
            return gamma / gamma.sum(axis=1, keepdims=True)

        return _counted(block, k, lambda i, j, a, b: drawn(a, b))

    def totals(state: RDD) -> np.ndarray:
        def add(sums: np.ndarray | None, block: tuple) -> np.ndarray:
            sums = np.zeros((size, k)) if sums is None else sums
            sums[block[2]] += block[1]
            return sums

        both = lambda a, b: b if a is None else a if b is None else a + b
        sums = state.treeAggregate(None, add, both)
        return np.zeros((size, k)) if sums is None else sums

    state = blocks.map(start).persist(StorageLevel.MEMORY_AND_DISK)
    counts, interval = totals(state), op.getCheckpointInterval()
    for step in range(1, op.getMaxIter() + 1):
        chances = context.broadcast(_smoothed(counts, eta))

        def expected(pair: tuple[Block, tuple], chances: Any = chances, alpha1: float = alpha - 1.0) -> tuple:
            block, (shares, _, _) = pair
            _, _, _, ends, places, _, terms = block
            phi, weights = chances.value[terms], shares + alpha1

            def share(i: int, j: int, a: int, b: int) -> np.ndarray:
                gamma = phi[places[a:b]] * np.repeat(weights[i:j], np.diff(ends[i:j + 1]), axis=0)
                gamma /= gamma.sum(axis=1, keepdims=True)
                return gamma

            return _counted(block, k, share)

        after = blocks.zip(state).map(expected).persist(StorageLevel.MEMORY_AND_DISK)
        if interval > 0 and step % interval == 0 and context.getCheckpointDir():
            after.checkpoint()
        counts = totals(after)
        state.unpersist()
        chances.unpersist()  # the driver keeps it, should a lost block be made again
        state = after
    files = [state.getCheckpointFile()] if state.getCheckpointFile() else []
    return _Fitted(spark, blocks, state, counts, alpha, eta, files)


def _counted(block: Block, k: int, share: Callable[[int, int, int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents by topics, terms by topics, the terms): counts dealt out by the shares of each term in its document."""
    _, _, ids, ends, places, counts, terms = block
    documents, words = np.zeros((len(ids), k)), np.zeros((len(terms), k))
    for i, j, a, b in _pieces(ends, k):
        dealt = share(i, j, a, b) * counts[a:b, None]
        documents[i:j] = np.add.reduceat(dealt, ends[i:j] - a, axis=0)
        for topic in range(k):
            words[:, topic] += np.bincount(places[a:b], dealt[:, topic], len(terms))
    return documents, words, terms


def _draws(seed: int, skip: int, count: int) -> np.ndarray:
    """``nextDouble`` of java.util.Random, from the one after ``skip`` of them; each takes two steps."""
    state = (seed ^ MULTIPLIER) & STATES
    factor, term, a, c, steps = 1, 0, MULTIPLIER, ADDEND, 2 * skip
    while steps:  # so many steps in one, by doubling
        if steps & 1:
            factor, term = factor * a & STATES, (term * a + c) & STATES
        a, c, steps = a * a & STATES, (a * c + c) & STATES, steps >> 1
    state = (state * factor + term) & STATES
    # products modulo 2^64 are right modulo 2^48
    powers = np.cumprod(np.full(2 * count, MULTIPLIER, np.uint64))
    offsets = np.cumsum(np.concatenate([[np.uint64(1)], powers[:-1]])) * np.uint64(ADDEND) if count else powers
    states = (powers * np.uint64(state) + offsets) & np.uint64(STATES)
    high, low = states[0::2] >> np.uint64(22), states[1::2] >> np.uint64(21)
    return ((high << np.uint64(27)) + low) * 2.0**-53


# the bound of the likelihood -----------------------------------------------------------


def _digamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers: moved up by ten, then the asymptotic series."""
    below, x = sum(1.0 / (x + i) for i in range(10)), x + 10.0
    square = 1.0 / (x * x)
    series = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square * (1 / 132)))))
    return np.log(x) - 0.5 / x - series - below


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in x.ravel().tolist()]).reshape(x.shape)


def _log_expectation(x: np.ndarray) -> np.ndarray:
    """Of a Dirichlet's shares, one distribution a row."""
    return _digamma(x) - _digamma(x.sum(axis=1, keepdims=True))


#: Seeded anew for each draw: making one costs more than the draws.
_TWISTER = np.random.RandomState(0)


def _gammas(seed: int, shape: float, k: int) -> list[float]:
    """``k`` draws of mean 1 as breeze takes them from a Mersenne twister seeded so."""
    seed &= (1 << 64) - 1
    _TWISTER.seed(np.array([seed >> 32, seed & 0xFFFFFFFF], np.uint32))
    raw: list[int] = []
    at, spare, out = 0, None, []
    b = shape - 1.0 / 3.0
    c = 1.0 / math.sqrt(9.0 * b)

    def uniform() -> float:
        nonlocal raw, at
        if at + 2 > len(raw):
            raw, at = _TWISTER._bit_generator.random_raw(8 * k).tolist(), 0
        at += 2
        return ((raw[at - 2] >> 6) << 26 | raw[at - 1] >> 6) * 2.0**-52

    def normal() -> float:
        nonlocal spare
        if spare is not None:
            x, spare = spare, None
            return x
        angle, u = 2.0 * math.pi * uniform(), uniform()
        far = math.sqrt(-2.0 * math.log(u))
        spare = far * math.sin(angle)
        return far * math.cos(angle)

    while len(out) < k:
        x = normal()
        v = 1.0 + c * x
        if v <= 0.0:
            continue
        v, u = v * v * v, uniform()
        if u < 1.0 - 0.0331 * x**4 or math.log(u) < 0.5 * x * x + b * (1.0 - v + math.log(v)):
            out.append(b * v / shape)
    return out


def _inferred(ends: np.ndarray, counts: np.ndarray, beta: np.ndarray, alpha: np.ndarray, gamma: np.ndarray) -> np.ndarray:
    """The topic weights of each document, taken on until they move by 0.001 or less; ``beta`` is by topic and term of a document."""
    gamma, sizes, alive = gamma.copy(), np.diff(ends), np.arange(len(gamma))
    while len(alive):
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        now = gamma[alive]
        moving = np.ones(len(alive), bool)
        while moving.sum() > 0.7 * len(alive):
            theta = np.exp(_log_expectation(now))
            norm = np.full(len(counts), 1e-100)
            for topic, row in enumerate(beta):
                norm += row * np.repeat(theta[:, topic], sizes)
            share = counts / norm
            after = np.stack([np.add.reduceat(row * share, starts) for row in beta], axis=1) * theta + alpha
            change = np.abs(after - now).mean(axis=1)
            now[moving] = after[moving]  # one that has settled stays
            moving &= change > 1e-3
        gamma[alive] = now
        left = np.repeat(moving, sizes)
        beta, counts, alive, sizes = beta[:, left], counts[left], alive[moving], sizes[moving]
    return gamma


def _likelihood_bound(
    df: DataFrame, features: str, topics: np.ndarray, alpha: np.ndarray, eta: float, shape: float, seed: int
) -> tuple[float, float]:
    """(bound of the documents' log likelihood, their words)."""
    size, k = topics.shape
    expected = _log_expectation(topics.T).T
    told = df.sparkSession.sparkContext.broadcast(expected)
    fixed = float(math.lgamma(alpha.sum()) - _lgamma(alpha).sum())

    def of(block: Block) -> tuple[float, float]:
        _, _, ids, ends, places, counts, terms = block
        own, bound = told.value[terms], 0.0
        for i, j, a, b in _pieces(ends, 16 * k):  # so few that they stay in the processor's cache
            some, sizes = ends[i:j + 1] - a, np.diff(ends[i:j + 1])
            start = np.array([_gammas(int(d) + seed, shape, k) for d in ids[i:j]])
            log_beta = own[places[a:b]]
            gamma = _inferred(some, counts[a:b], np.exp(log_beta.T), alpha, start)
            theta = _log_expectation(gamma)
            both = np.repeat(theta, sizes, axis=0) + log_beta
            most = both.max(axis=1)
            bound += float(counts[a:b] @ (most + np.log(np.exp(both - most[:, None]).sum(axis=1))))
            bound += float(((alpha - gamma) * theta).sum() + _lgamma(gamma).sum() - _lgamma(gamma.sum(axis=1)).sum()) + fixed * (j - i)
        return bound, float(counts.sum())

    found = _blocks(df, features).map(of).treeAggregate((0.0, 0.0), lambda x, y: (x[0] + y[0], x[1] + y[1]), lambda x, y: (x[0] + y[0], x[1] + y[1]))
    told.unpersist()
    over_topics = float(((eta - topics) * expected).sum() + _lgamma(topics).sum() - topics.size * math.lgamma(eta)
                        + k * math.lgamma(eta * size) - _lgamma(topics.sum(axis=0)).sum())
    return found[0] + over_topics, found[1]
