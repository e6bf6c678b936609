"""Domain operators: each takes and returns DataFrames built from Spark's own
functions, so Catalyst plans them and they run distributed."""
