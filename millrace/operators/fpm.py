"""Frequent patterns. PrefixSpan is a helper: it answers a frame, there is no model."""

from pyspark.ml import fpm as ml

from .base import constructor

fp_growth = constructor(ml.FPGrowth)
prefix_span = constructor(ml.PrefixSpan)
