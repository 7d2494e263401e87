"""Shop mart: a retail clickstream warehouse built from PySpark DataFrames."""
