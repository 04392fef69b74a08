"""Query catalogue over the test tables (``catalog``) and the independent
DuckDB SQL for each deterministic query (``oracles``)."""
