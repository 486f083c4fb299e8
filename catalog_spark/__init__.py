"""Product-catalog analytics on Spark: ingest, clean, featurise, cluster, diagnose."""
