"""Tabular and text modelling work as Spark jobs.

``sources``    contracts, scans, provenance, result and model sinks
``functions``  column expressions (parsing, text, flags)
``operators``  profiling, cleaning, splitting, features, models, metrics, tuning
``plans``      the registered queries with their SQL twins
"""
