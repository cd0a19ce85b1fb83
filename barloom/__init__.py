"""barloom: daily price-bar (OHLCV) processing on Spark DataFrames."""
