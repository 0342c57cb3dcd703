"""Event analytics on Spark: pointer heatmaps and per-user top-K item counts."""
