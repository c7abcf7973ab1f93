"""ordlog: ordered record logs on Spark DataFrames."""
