"""The end-to-end job, the query registry and its DuckDB oracle."""
