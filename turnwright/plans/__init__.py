"""Named queries over the driver tables, with the same in DuckDB's SQL."""
