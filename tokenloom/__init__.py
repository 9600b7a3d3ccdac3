"""Language-model data preparation and training analytics on Spark DataFrames."""
