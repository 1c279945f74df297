"""Export-trade analytics as composable Spark DataFrame transforms.

Layout
------
``functions``  column helpers: exact rounding, guarded division, bands, bins
``sources``    schemas, readers/writers, view registry, calendar spine, test-table mapping
``operators``  row enrichment, data quality, aggregation, ranking and set-relative operators
``plans``      the fifteen KPI views and the analysis operators built on them
"""
