"""Order-level retail sales analytics as Spark DataFrames.

``functions``  column expressions (exact sums, bands, labels, question text)
``sources``    schemas, readers, writers, the shared work folder
``operators``  data quality, features, pricing, ranking, skew-safe lookups
``plans``      the reports, the star schema and its measures
``registry``   every query by name, with the SQL it is checked against
"""
