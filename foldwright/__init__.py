"""Tabular profiling and cross-validated model comparison on Spark.

``sources``    scans, sinks and the applicants view
``functions``  column expressions (dates, scores, key hashing)
``operators``  DataFrame -> DataFrame steps
``plans``      the steps put together: features, model study, cluster study
"""
