"""Radio-propagation observations and space-weather indices as Spark DataFrames."""
