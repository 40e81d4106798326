"""Table schemas from the session's catalog; primary keys from a table property."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..errors import SchemaError
from ..types import TableSchema, split_name

#: The table property with the primary key's columns, in key order, comma-separated.
KEY_PROPERTY = "weirline.primary_key"


def fetch_schema(spark: SparkSession, table: str, default: str = "default", db_id: int = 0, rel_id: int = 0) -> TableSchema:
    schema, name = split_name(table, default)
    full = f"`{schema}`.`{name}`"
    if not spark.catalog.tableExists(full):
        raise SchemaError(f"there is no table {table}")
    shown = spark.sql(f"SHOW TBLPROPERTIES {full}").collect()
    key = next((r.value for r in shown if r.key == KEY_PROPERTY), "")
    return TableSchema(spark.table(full).schema, tuple(k.strip() for k in key.split(",") if k.strip()), db_id, rel_id)
