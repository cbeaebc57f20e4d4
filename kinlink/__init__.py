"""kinlink: Spark-first record linkage."""
