"""DuckDB oracle for the registered queries (independent plain-SQL rebuild)."""
