"""Word and letter frequency bands of large text collections, as PySpark DataFrames."""
