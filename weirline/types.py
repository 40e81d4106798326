"""Declared column types, the whitelist, and schema checks. Nothing is coerced; what isn't listed is refused."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from .errors import SchemaError, UnsupportedType

#: Declared names without parameters (fixed values).
PLAIN = {
    "boolean": T.BooleanType(), "smallint": T.ShortType(), "integer": T.IntegerType(), "bigint": T.LongType(),
    "real": T.FloatType(), "double precision": T.DoubleType(), "text": T.StringType(), "bytea": T.BinaryType(), "date": T.DateType(),
    "character varying": T.StringType(), "timestamp without time zone": T.TimestampNTZType(), "timestamp with time zone": T.TimestampType(),
}
_NUMERIC = re.compile(r"numeric\((\d+)(?:,\s*(-?\d+))?\)")
_SIZED = re.compile(r"(?:character varying|character)\(\d+\)")
_STAMP = re.compile(r"timestamp\([0-6]\) (with|without) time zone")
#: Types that can be rendered; those in KEYS can be part of a primary key of an upsert stream.
KEYS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
WHITELIST = (*KEYS, T.FloatType, T.DoubleType)


def parse_type(declared: str) -> T.DataType:
    """The Spark type of a declared column type."""
    if declared in PLAIN:
        return PLAIN[declared]
    if m := _NUMERIC.fullmatch(declared):
        precision, scale = int(m[1]), int(m[2] or 0)
        if not 1 <= precision <= 38 or not 0 <= scale <= precision:
            raise UnsupportedType(f"{declared}: precision 1 to 38 and a scale from 0 to the precision are supported")
        return T.DecimalType(precision, scale)
    if declared == "numeric":
        raise UnsupportedType("numeric needs a precision")
    if _SIZED.fullmatch(declared):
        return T.StringType()
    if m := _STAMP.fullmatch(declared):
        return T.TimestampType() if m[1] == "with" else T.TimestampNTZType()
    raise UnsupportedType(declared)


def same_schema(a: T.StructType, b: T.StructType) -> bool:
    """Number, order, names and types of columns; nullability and metadata don't count."""
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


@dataclass(frozen=True)
class TableSchema:
    """A table's columns, its primary key in key order, and its identity."""

    columns: T.StructType
    key: tuple[str, ...] = ()
    db_id: int = 0
    rel_id: int = 0

    def check(self, upsert: bool) -> None:
        for f in self.columns:
            if not isinstance(f.dataType, WHITELIST):
                raise UnsupportedType(f"{f.name}: {f.dataType.simpleString()}")
        if not upsert:
            return
        if not self.key:
            raise SchemaError("an upsert stream needs a primary key")
        for name in self.key:
            if name not in self.columns.names:
                raise SchemaError(f"{name} is no column")
            if not isinstance(self.columns[name].dataType, KEYS):
                raise UnsupportedType(f"{name}: {self.columns[name].dataType.simpleString()} can't be a key")


def split_name(name: str, default: str = "public") -> tuple[str, str]:
    """schema.table, cut at the first dot."""
    schema, dot, table = name.partition(".")
    if not dot:
        schema, table = default, schema
    if not schema or not table:
        raise SchemaError(f"{name!r} is no table name")
    return schema, table
