"""Road-survey conditioning on Spark DataFrames."""
