"""textmill: text curation and training-data preparation on Spark DataFrames."""
