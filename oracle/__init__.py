"""DuckDB oracle SQL for the registered queries (see ``oracle.sql``)."""
