"""tidemark: bitemporal event intelligence on Spark DataFrames."""
