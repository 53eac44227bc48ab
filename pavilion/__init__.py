"""Star-schema analytics for ball-by-ball match data, as plain Spark DataFrames."""
