"""Florilege: corpus analytics on Spark.  Subpackages are imported explicitly."""
