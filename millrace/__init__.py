"""Process time-series quality analytics on Spark DataFrames and streams."""
