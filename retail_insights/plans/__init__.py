"""Job plans (bronze ingestion, gold jobs), the registered queries and their
DuckDB oracle text."""
