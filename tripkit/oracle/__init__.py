"""DuckDB SQL equivalents of the registered queries (correctness oracle)."""

from .duckdb_sql import ORACLE_SQL  # noqa: F401
