"""State-maintenance operators on DataFrames."""
