"""Current-state maintenance for snapshot extracts, expressed with Spark DataFrames."""
