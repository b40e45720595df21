"""Alternating least squares."""

from pyspark.ml import recommendation as ml

from .base import constructor

als = constructor(ml.ALS)
