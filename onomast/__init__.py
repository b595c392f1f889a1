"""Name-statistics analytics on Spark: DataFrame → DataFrame operators with columns as parameters."""
