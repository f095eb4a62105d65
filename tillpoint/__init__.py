"""Customer value analytics for shops with a points programme, on Spark DataFrames."""
