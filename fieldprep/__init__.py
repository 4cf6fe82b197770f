"""Field-inspection data preparation on Spark DataFrames."""
