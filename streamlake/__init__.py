"""streamlake: a raw -> clean -> analytics lake for event data, built on Spark DataFrames."""
