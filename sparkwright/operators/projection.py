"""Row-wise operators: projections, filters, splits, keying, reader schemas."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def positional(df: DataFrame, i: int) -> Column:
    """``$i``: the i-th column (0-based)."""
    return F.col(df.columns[i])


def split_relation(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """SPLIT df INTO a IF cond, b OTHERWISE (null condition -> otherwise)."""
    c = F.coalesce(cond, F.lit(False))
    return df.where(c), df.where(~c)


def key_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """(key, *columns) with the key computed from each row."""
    return df.select(key.alias(name), *df.columns)


def swap(df: DataFrame, k: str = "key", v: str = "value") -> DataFrame:
    """(k, v) -> (v as k, k as v)."""
    return df.select(F.col(v).alias(k), F.col(k).alias(v))


class SchemaMismatch(ValueError):
    """Reader schema cannot be resolved against the data's schema."""


_WIDENING = {
    ("int", "bigint"), ("int", "float"), ("int", "double"), ("bigint", "float"),
    ("bigint", "double"), ("float", "double"), ("string", "binary"), ("binary", "string"),
}


def resolve_reader_schema(df: DataFrame, reader: T.StructType,
                          aliases: Mapping[str, list[str]] | None = None,
                          defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Read ``df`` through a reader schema (schema evolution rules).

    A reader field is taken from the writer field of the same name or of
    one of its aliases (old names are then gone); a field absent from the
    data takes its default (null if none); a type change must be a
    widening (int -> long/float/double, ...) or :class:`SchemaMismatch` is
    raised; writer fields not in the reader schema are dropped.
    """
    aliases = aliases or {}
    defaults = defaults or {}
    writer = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in reader.fields:
        src = next((n for n in [f.name, *aliases.get(f.name, [])] if n in writer), None)
        if src is None:
            if f.name in defaults:
                out.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
            elif f.nullable:
                out.append(F.lit(None).cast(f.dataType).alias(f.name))
            else:
                raise SchemaMismatch(f"field {f.name} missing and has no default")
            continue
        wt, rt = writer[src], f.dataType
        if wt != rt and (wt.simpleString(), rt.simpleString()) not in _WIDENING:
            raise SchemaMismatch(f"field {f.name}: {wt.simpleString()} cannot be read as "
                                 f"{rt.simpleString()}")
        col = F.col(src) if wt == rt else F.col(src).cast(rt)
        out.append(col.alias(f.name))
    return df.select(*out)


def read_parquet_as(spark: SparkSession, path: str, reader: T.StructType,
                    aliases: Mapping[str, list[str]] | None = None,
                    defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Parquet read resolved through a reader schema; only the needed
    writer columns reach the scan (the projection prunes the rest)."""
    return resolve_reader_schema(spark.read.parquet(path), reader, aliases, defaults)
