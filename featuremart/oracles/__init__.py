"""The same results in plain SQL, for checking the queries in DuckDB."""
