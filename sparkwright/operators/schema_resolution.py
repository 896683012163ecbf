"""Reading data through another schema, at any depth.

The reader's schema is a ``StructType`` whose fields may carry former names and a
default (:func:`reader_field`).  The rules hold in structs, arrays and map values alike:

* a field is taken from the writer's field of its name, else of a former name;
* a field that the data does not have takes its default, else null; a field
  that must not be null and has neither is an error;
* fields that the reader does not have are dropped and not read;
* a type may widen (``WIDENING``, and decimals that lose nothing); all else is
  an error;
* a null struct, array or map stays null.

All errors are found before anything runs and are reported together, each with
its path (``body.tags[].rank``, ``{}`` for map values).  The result is one projection.
"""

from __future__ import annotations

import json
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .projection import SchemaMismatch

_NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
#: (from, to) pairs that may be read as one another.
WIDENING = {(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1:]} | {
    (T.StringType(), T.BinaryType()), (T.BinaryType(), T.StringType())}
_NO_DEFAULT = object()


def reader_field(name: str, kind: T.DataType, nullable: bool = True, former: Sequence[str] = (),
                 default: Any = _NO_DEFAULT) -> T.StructField:
    """A field of a reader's schema; the default is anything JSON can hold."""
    notes: dict[str, Any] = {"former": list(former)} if former else {}
    if default is not _NO_DEFAULT:
        notes["default"] = json.dumps(default)
    return T.StructField(name, kind, nullable, notes)


def _default(field: T.StructField) -> Column:
    value = json.loads(field.metadata["default"])
    if value is None:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(F.lit(json.dumps({"v": value})), T.StructType([T.StructField("v", field.dataType)]))["v"]
    return F.lit(value).cast(field.dataType)


def _widens(writer: T.DataType, reader: T.DataType) -> bool:
    if isinstance(writer, T.DecimalType) and isinstance(reader, T.DecimalType):
        return reader.scale >= writer.scale and reader.precision - reader.scale >= writer.precision - writer.scale
    return (writer, reader) in WIDENING


def _plain(kind: T.DataType) -> str:
    """The type without notes and null marks, for comparison and messages."""
    return kind.simpleString()


def _noted(kind: T.DataType) -> bool:
    """Whether some field below has former names (the data may have them under another name)."""
    if isinstance(kind, T.StructType):
        return any(f.metadata.get("former") or _noted(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _noted(kind.elementType)
    return isinstance(kind, T.MapType) and _noted(kind.valueType)


def _value(column: Column, writer: T.DataType, reader: T.DataType, path: str, errors: list[str]) -> Column:
    if _plain(writer) == _plain(reader) and not _noted(reader):
        return column
    if isinstance(writer, T.StructType) and isinstance(reader, T.StructType):
        fields = _fields(lambda name: column[name], writer, reader, path + ".", errors)
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else column
    if isinstance(writer, T.ArrayType) and isinstance(reader, T.ArrayType):
        _value(F.lit(None), writer.elementType, reader.elementType, f"{path}[]", errors)
        return F.transform(column, lambda x: _value(x, writer.elementType, reader.elementType, "", []))
    if isinstance(writer, T.MapType) and isinstance(reader, T.MapType):
        if _plain(writer.keyType) != _plain(reader.keyType):
            errors.append(f"{path}: keys {_plain(writer.keyType)} cannot be read as {_plain(reader.keyType)}")
        _value(F.lit(None), writer.valueType, reader.valueType, f"{path}{{}}", errors)
        return F.transform_values(column, lambda _, x: _value(x, writer.valueType, reader.valueType, "", []))
    if not _widens(writer, reader):
        errors.append(f"{path}: {_plain(writer)} cannot be read as {_plain(reader)}")
    return column.cast(reader)


def _fields(get, writer: T.StructType, reader: T.StructType, prefix: str, errors: list[str]) -> list[Column]:
    there, out = {f.name: f.dataType for f in writer.fields}, []
    for field in reader.fields:
        path = prefix + field.name
        source = next((n for n in [field.name, *field.metadata.get("former", [])] if n in there), None)
        if source is not None:
            out.append(_value(get(source), there[source], field.dataType, path, errors).alias(field.name))
        elif "default" in field.metadata:
            out.append(_default(field).alias(field.name))
        elif field.nullable:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            errors.append(f"{path}: missing, and it has no default")
    return out


def read_as(df: DataFrame, reader: T.StructType) -> DataFrame:
    """The data in the reader's schema; :class:`SchemaMismatch` names every path that cannot be resolved."""
    errors: list[str] = []
    columns = _fields(lambda name: F.col(f"`{name}`"), df.schema, reader, "", errors)
    if errors:
        raise SchemaMismatch("; ".join(errors))
    return df.select(*columns)
