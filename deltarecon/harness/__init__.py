"""Test harness: fixtures derived from the driver tables, the registered
queries (``queries.QUERIES``) and their DuckDB oracles (``oracles.ORACLES``)."""
