"""Sky-obstruction screening and corpus preparation on Spark DataFrames."""
