"""hintforge: protein-hint analytics on Spark DataFrames."""
