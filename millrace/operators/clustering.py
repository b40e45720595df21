"""Clusterers. Power iteration is a helper: it is run on an edge list, not fitted."""

from pyspark.ml import clustering as ml

from . import topics
from .base import constructor

bisecting_k_means = constructor(ml.BisectingKMeans)
gaussian_mixture = constructor(ml.GaussianMixture)
k_means = constructor(ml.KMeans)
lda = constructor(topics.LDA)
power_iteration_clustering = constructor(ml.PowerIterationClustering)
