"""Query plans over the derived map tables, with their DuckDB counterparts."""
