"""Named queries over the test tables and their independent DuckDB oracles."""
