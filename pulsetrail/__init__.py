"""Session and wait-event history analytics on Spark DataFrames."""
