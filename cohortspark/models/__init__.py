"""Model training and scoring on Spark MLlib, and evaluation as DataFrames."""
