"""Analytic jobs on Spark: text corpora, key aggregates, graphs, splits, models, streams."""
