"""Analytics over rendered thermal video as Spark DataFrames."""
