"""Sources and sinks: Parquet tables, CSV exports, result tables."""

from .bucketed import BucketedFact
from .csv import CORRUPT, load_csv
from .incremental import FactStore, history
from .sinks import export_csv, publish, read_clean, write_clean
from .tables import SCHEMAS, Tables, load, read_table, register, schema

__all__ = ["BucketedFact", "CORRUPT", "FactStore", "SCHEMAS", "Tables", "export_csv", "history", "load", "load_csv", "publish",
           "read_clean", "read_table", "register", "schema", "write_clean"]
