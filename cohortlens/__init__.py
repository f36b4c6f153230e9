"""cohortlens: marketing-funnel analytics as Spark DataFrame jobs.

Subpackages: ``sources`` (contracts, readers, sinks, fixture projection),
``functions`` (column expressions), ``operators`` (reusable aggregations,
joins, windows and order statistics), ``plans`` (the models, checks,
profiles, model training and report frames), ``streaming`` (scheduled
ingestion of new raw files).
"""
