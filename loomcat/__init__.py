"""loomcat: catalog integration on Spark DataFrames."""
