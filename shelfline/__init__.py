"""Store-and-item demand analytics and replenishment on Spark DataFrames."""
