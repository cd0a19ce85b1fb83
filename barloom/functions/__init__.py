"""Column functions: naming, tickers, type coercion, ingest outcomes."""
