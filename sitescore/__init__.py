"""Location analytics and site selection on Spark DataFrames."""
