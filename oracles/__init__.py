"""DuckDB statements that state each result independently, for the correctness check."""
