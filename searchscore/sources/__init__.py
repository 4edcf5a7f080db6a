"""Readers, writers, schemas and the derived test inputs."""
from .readers import (ATTRIBUTES_SCHEMA, DESCRIPTIONS_SCHEMA, SCHEMAS, TRAIN_SCHEMA,
                      read_csv, read_parquet, read_sources, write_csv, write_parquet)
from .fixtures import FIXTURE_SQL, base_table, cte, duckdb_sql, fixture, fixtures

__all__ = ["ATTRIBUTES_SCHEMA", "DESCRIPTIONS_SCHEMA", "SCHEMAS", "TRAIN_SCHEMA", "read_csv",
           "read_parquet", "read_sources", "write_csv", "write_parquet", "FIXTURE_SQL", "base_table", "cte",
           "duckdb_sql", "fixture", "fixtures"]
