"""Irregular per-visit records to decision data sets, as Spark DataFrame functions."""
