"""Check queries over the given tables, each with its DuckDB statement where SQL can say it."""
