"""Fitted models as plain column expressions.

A model's own ``transform`` packs numbers into a vector and calls a function per row.
Where the scoring rule is closed form, ``columns(model, inputs)`` writes it over the raw
numeric columns instead, so it runs inside generated code, filters push past it and only
the columns it names are read. ``inputs`` are in the order they were assembled in.

A null input gives null outputs where ``transform`` refuses it, so does NaN; else both give
what ``transform`` gives. Expressions grow with classes times inputs, so a classifier of more than
``WIDE`` such products is scored in another form: the model's own transform with its outputs unpacked
to the same columns, nulls for rows with a null among them. ``form`` takes either by name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.ml import classification as cls
from pyspark.ml import clustering as clu
from pyspark.ml import feature as fea
from pyspark.ml import regression as reg
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Inputs = Sequence[str | Column]
#: Products of classes and inputs that a classifier is written out with; beyond it vectors are faster.
WIDE = 160


def columns(model: Any, inputs: Inputs) -> dict[str, Column]:
    """Output name -> expression. Vector outputs become ``name_0``, ``name_1``, ..."""
    xs = [(F.col(x) if isinstance(x, str) else x).cast("double") for x in inputs]
    for kind, rule in _RULES:
        if isinstance(model, kind):
            return rule(model, xs)
    for kind, rule in _STAGED:
        if isinstance(model, kind):
            return rule(model, xs, list)
    raise TypeError(f"{type(model).__name__} has no column form; use transform")


def score(
    model: Any, df: DataFrame, inputs: Inputs, keep: Sequence[str] = (), form: str | None = None
) -> DataFrame:
    """``keep`` plus the scored columns, as expressions over the scan (``form="columns"``) or
    by the model's transform (``"vector"``; the default of wide classifiers). Classifiers and
    clusterers name their raw values once, in a projection below, and refer to them, so their
    plans grow with classes times inputs."""
    if form is None:
        form = "vector" if wide(model, len(inputs)) else "columns"
    if form == "vector":
        return _by_transform(model, df, inputs, keep)
    if form != "columns":
        raise ValueError("form must be columns or vector")
    for kind, rule in _STAGED:
        if isinstance(model, kind):
            break
    else:
        return df.select(*keep, *[c.alias(n) for n, c in columns(model, inputs).items()])
    frame, count = df, 0

    def named(values: Sequence[Column]) -> list[Column]:
        nonlocal frame, count
        names = [f"_held_{count + i}" for i in range(len(values))]
        count += len(values)
        frame = frame.select("*", *[v.alias(n) for v, n in zip(values, names)])
        return [F.col(n) for n in names]

    out = rule(model, [(F.col(x) if isinstance(x, str) else x).cast("double") for x in inputs], named)
    return frame.select(*keep, *[c.alias(n) for n, c in out.items()])


def wide(model: Any, inputs: int) -> bool:
    """Whether a model is a classifier of more than ``WIDE`` products of classes and inputs."""
    return isinstance(model, tuple(kind for kind, _ in _STAGED)) and getattr(model, "numClasses", 0) * inputs > WIDE


def _by_transform(model: Any, df: DataFrame, inputs: Inputs, keep: Sequence[str]) -> DataFrame:
    from ..functions.vectors import vector_to_array

    xs = [(F.col(x) if isinstance(x, str) else x).cast("double") for x in inputs]
    there = reduce(lambda a, b: a & b, [x.isNotNull() for x in xs])
    filled = F.array(*[F.coalesce(x, F.lit(0.0)) for x in xs])  # a transform stops at a null
    packed = df.select(*keep, array_to_vector(filled).alias(model.getFeaturesCol()), there.alias("_whole_row"))
    done = model.transform(packed)
    out = [F.when(F.col("_whole_row"), F.col(model.getPredictionCol())).alias(model.getPredictionCol())]
    for name in ("probabilityCol", "rawPredictionCol"):
        if model.hasParam(name):
            column = model.getOrDefault(name)
            array = vector_to_array(column)
            out += [F.when(F.col("_whole_row"), array[i]).alias(f"{column}_{i}") for i in range(model.numClasses)]
    return done.select(*keep, *out)


def _over(x: Column, limit: float) -> Column:
    """1.0 above the limit, else 0.0; NaN is not above, null stays null."""
    return F.when(x.isNull(), F.lit(None).cast("double")).when(~F.isnan(x) & (x > F.lit(limit)), 1.0).otherwise(0.0)


def dot(weights: Sequence[float], xs: Sequence[Column], start: float | None = None) -> Column:
    terms = [F.lit(float(w)) * x for w, x in zip(weights, xs, strict=True)]
    return reduce(lambda a, b: a + b, terms) + F.lit(float(start or 0.0))


def _vector(name: str, values: Sequence[Column]) -> dict[str, Column]:
    return {f"{name}_{i}": v for i, v in enumerate(values)}


def _inverse(x: float) -> float:
    return 1.0 / x if x != 0.0 else 0.0


# scalers ------------------------------------------------------------------------------


def _standard(m, xs):
    means = list(m.mean) if m.getWithMean() else [0.0] * len(xs)
    scale = [_inverse(s) for s in m.std] if m.getWithStd() else [1.0] * len(xs)
    return _vector(m.getOutputCol(), [(x - F.lit(float(a))) * F.lit(float(s)) for x, a, s in zip(xs, means, scale)])


def _min_max(m, xs):
    low, high = m.getMin(), m.getMax()
    out = []
    for x, a, b in zip(xs, m.originalMin, m.originalMax):
        a, b = float(a), float(b)
        out.append(
            F.lit(0.5 * (low + high))
            if a == b
            else (x - F.lit(a)) / F.lit(b - a) * F.lit(high - low) + F.lit(low)
        )
    return _vector(m.getOutputCol(), out)


def _max_abs(m, xs):
    return _vector(m.getOutputCol(), [x / F.lit(float(a) if a else 1.0) for x, a in zip(xs, m.maxAbs)])


def _robust(m, xs):
    middles = [float(v) for v in m.median] if m.getWithCentering() else [0.0] * len(xs)
    scale = [_inverse(float(r)) for r in m.range] if m.getWithScaling() else [1.0] * len(xs)
    return _vector(m.getOutputCol(), [(x - F.lit(a)) * F.lit(s) for x, a, s in zip(xs, middles, scale)])


def _product(m, xs):
    return _vector(m.getOutputCol(), [x * F.lit(float(w)) for x, w in zip(xs, m.getScalingVec())])


def _normalize(m, xs):
    p = m.getP()
    if math.isinf(p):
        norm = F.greatest(*[F.abs(x) for x in xs]) if len(xs) > 1 else F.abs(xs[0])
    elif p == 2.0:
        norm = F.sqrt(reduce(lambda a, b: a + b, [x * x for x in xs]))
    else:
        norm = F.pow(reduce(lambda a, b: a + b, [F.pow(F.abs(x), F.lit(p)) for x in xs]), F.lit(1.0 / p))
    return _vector(m.getOutputCol(), [F.when(norm == 0.0, x).otherwise(x / norm) for x in xs])


def _slice(m, xs):
    if m.getNames():
        raise TypeError("a slice by attribute name needs the vector's metadata; use transform")
    return _vector(m.getOutputCol(), [xs[i] for i in m.getIndices()])


def _kept(m, xs):
    return _vector(m.getOutputCol(), [xs[i] for i in sorted(m.selectedFeatures)])


def _project(m, xs):
    loadings = m.pc.toArray()
    return _vector(m.getOutputCol(), [dot(loadings[:, k], xs) for k in range(loadings.shape[1])])


# value by value -----------------------------------------------------------------------


def _outputs(m, n):
    return m.getOutputCols() if m.isSet("outputCols") else [m.getOutputCol()][:n]


def _binarize(m, xs):
    limits = m.getThresholds() if m.isSet("thresholds") else [m.getThreshold()] * len(xs)
    return {
        # as transform does, null is not above
        name: F.when(~F.isnan(x) & (x > F.lit(float(t))), 1.0).otherwise(0.0)
        for name, x, t in zip(_outputs(m, len(xs)), xs, limits)
    }


def _bucketize(m, xs):
    if m.getHandleInvalid() != "error":
        raise TypeError("only handleInvalid=error has a column form; use transform")
    rules = m.getSplitsArray() if m.isSet("splitsArray") else [m.getSplits()] * len(xs)
    out = {}
    for name, x, splits in zip(_outputs(m, len(xs)), xs, rules):
        inside = (x >= splits[0]) & (x <= splits[-1]) & ~F.isnan(x)
        branch = F.when(~inside | x.isNull(), F.raise_error(F.lit(f"{name}: value outside the splits")).cast("double"))
        for i, edge in enumerate(splits[1:-1]):
            branch = branch.when(x < edge, float(i))
        out[name] = branch.otherwise(float(len(splits) - 2))
    return out


def _impute(m, xs):
    # one row of surrogates, whatever the table's size
    surrogates = m.surrogateDF.first()
    names = m.getInputCols() if m.isSet("inputCols") else [m.getInputCol()]
    gap = m.getMissingValue()
    out = {}
    for name, source, x in zip(_outputs(m, len(xs)), names, xs):
        missing = x.isNull() | (F.isnan(x) if math.isnan(gap) else x == F.lit(gap))
        out[name] = F.when(missing, float(surrogates[source])).otherwise(x)
    return out


# linear models ------------------------------------------------------------------------


def _linear(m, xs):
    return {m.getPredictionCol(): dot(m.coefficients, xs, m.intercept)}


def _aft(m, xs):
    return {m.getPredictionCol(): F.exp(dot(m.coefficients, xs, m.intercept))}


def _glm(m, xs):
    eta = dot(m.coefficients, xs, m.intercept)
    defaults = {"gaussian": "identity", "binomial": "logit", "poisson": "log", "gamma": "inverse"}
    if m.getFamily() == "tweedie":
        raise TypeError("a tweedie model has no column form; use transform")
    if m.isSet("offsetCol"):
        raise TypeError("a model with an offset has no column form; use transform")
    link = m.getLink() if m.isSet("link") else defaults[m.getFamily()]
    inverse = {
        "identity": lambda e: e,
        "log": F.exp,
        "logit": lambda e: 1.0 / (1.0 + F.exp(-e)),
        "inverse": lambda e: 1.0 / e,
        "sqrt": lambda e: e * e,
        "cloglog": lambda e: 1.0 - F.exp(-F.exp(e)),
    }
    if link not in inverse:
        raise TypeError(f"link {link} has no column form; use transform")
    return {m.getPredictionCol(): inverse[link](eta)}


def _svc(m, xs):
    margin = dot(m.coefficients, xs, m.intercept)
    return {
        m.getPredictionCol(): _over(margin, m.getThreshold()),
        f"{m.getRawPredictionCol()}_0": -margin,
        f"{m.getRawPredictionCol()}_1": margin,
    }


def _argmax(values: Sequence[Column], named: Callable) -> Column:
    """The place of the first largest value. NaN first gives 0, NaN elsewhere never wins."""
    first, *_ = values
    values = named([F.nanvl(v, F.lit(-math.inf)) for v in values])
    (top,) = named([F.greatest(*values)])
    branch = F.when(top.isNull(), F.lit(None).cast("double")).when(F.isnan(first) | (values[0] == top), 0.0)
    for i, v in enumerate(values[1:-1], start=1):
        branch = branch.when(v == top, float(i))
    return branch.otherwise(float(len(values) - 1))


def _softmax(raw: Sequence[Column], named: Callable) -> list[Column]:
    (top,) = named([F.greatest(*raw)])
    powers = named([F.exp(r - top) for r in raw])
    (total,) = named([reduce(lambda a, b: a + b, powers)])
    return named([p / total for p in powers])


def _thresholded(m, probabilities, named):
    if not m.isSet("thresholds"):
        return _argmax(probabilities, named)
    # a zero threshold always wins, as an infinite ratio does
    return _argmax(named([
        p / F.lit(float(t)) if t > 0 else F.lit(math.inf) for p, t in zip(probabilities, m.getThresholds())
    ]), named)


def _logistic(m, xs, named):
    if m.numClasses == 2 and m.coefficientMatrix.numRows == 1:
        (margin,) = named([dot(m.coefficients, xs, m.intercept)])
        (up,) = named([1.0 / (1.0 + F.exp(-margin))])
        probabilities, raw = [1.0 - up, up], [-margin, margin]
        if m.isSet("thresholds"):
            prediction = _thresholded(m, probabilities, named)
        else:
            prediction = _over(up, m.getThreshold())
    else:
        weights = m.coefficientMatrix.toArray()
        raw = named([dot(weights[k], xs, m.interceptVector[k]) for k in range(m.numClasses)])
        probabilities = _softmax(raw, named)
        prediction = _thresholded(m, probabilities, named) if m.isSet("thresholds") else _argmax(raw, named)
    return {
        m.getPredictionCol(): prediction,
        **_vector(m.getProbabilityCol(), probabilities),
        **_vector(m.getRawPredictionCol(), raw),
    }


def _bayes(m, xs, named):
    if m.getModelType() != "multinomial":
        raise TypeError(f"a {m.getModelType()} model has no column form; use transform")
    theta, prior = m.theta.toArray(), m.pi.toArray()
    raw = named([dot(theta[k], xs, prior[k]) for k in range(m.numClasses)])
    probabilities = _softmax(raw, named)
    return {
        m.getPredictionCol(): _thresholded(m, probabilities, named),
        **_vector(m.getProbabilityCol(), probabilities),
        **_vector(m.getRawPredictionCol(), raw),
    }


def _nearest_center(m, xs, named):
    if m.getDistanceMeasure() != "euclidean":
        raise TypeError("only euclidean distance has a column form; use transform")
    distances = named([
        -reduce(lambda a, b: a + b, [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(xs, center)])
        for center in m.clusterCenters()
    ])
    # transform refuses NaN; here such a row has no cluster
    return {m.getPredictionCol(): F.when(~F.isnan(distances[0]), _argmax(distances, named)).cast("int")}


_RULES = [
    (fea.StandardScalerModel, _standard),
    (fea.MinMaxScalerModel, _min_max),
    (fea.MaxAbsScalerModel, _max_abs),
    (fea.RobustScalerModel, _robust),
    (fea.ElementwiseProduct, _product),
    (fea.Normalizer, _normalize),
    (fea.VectorSlicer, _slice),
    (fea.VarianceThresholdSelectorModel, _kept),
    (fea.UnivariateFeatureSelectorModel, _kept),
    (fea.ChiSqSelectorModel, _kept),
    (fea.PCAModel, _project),
    (fea.Binarizer, _binarize),
    (fea.Bucketizer, _bucketize),
    (fea.ImputerModel, _impute),
    (reg.LinearRegressionModel, _linear),
    (reg.AFTSurvivalRegressionModel, _aft),
    (reg.GeneralizedLinearRegressionModel, _glm),
    (cls.LinearSVCModel, _svc),
]
#: Rules that name what they use more than once.
_STAGED = [
    (cls.LogisticRegressionModel, _logistic),
    (cls.NaiveBayesModel, _bayes),
    (clu.KMeansModel, _nearest_center),
]
