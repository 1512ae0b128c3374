"""Land-change analytics on Spark: every map is a DataFrame keyed by cell."""
