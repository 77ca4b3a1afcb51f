"""Stage plans, the daily run and the query catalogue."""
