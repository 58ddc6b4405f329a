"""Job wiring (job), analog test inputs (fixtures), query catalogue and its DuckDB oracle."""
