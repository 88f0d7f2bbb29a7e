"""Named queries and their DuckDB oracle statements."""
