"""Change-data operators for Spark: every operator is a lazy DataFrame -> DataFrame function."""
