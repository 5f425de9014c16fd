"""Clinical document building and synchronisation on Spark DataFrames."""
