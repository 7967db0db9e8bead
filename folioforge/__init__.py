"""folioforge: document-corpus processing on Spark DataFrames."""
