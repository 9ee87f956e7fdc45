"""Reading fields of nested records: a missing value becomes a default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StructType

_TYPE_OF_DEFAULT = {str: "string", int: "bigint", float: "double", bool: "boolean"}


def field_type(schema: StructType, path: str) -> DataType | None:
    """Type at a dotted path, or None where the export lacks the field."""
    dtype: DataType = schema
    for name in path.split("."):
        if not isinstance(dtype, StructType) or name not in dtype.names:
            return None
        dtype = dtype[name].dataType
    return dtype


def as_text(value: Column, dtype: DataType) -> Column:
    """Text of a value: ``True``/``False`` for booleans, JSON for nested values."""
    if isinstance(dtype, BooleanType):
        return F.initcap(value.cast("string"))
    if isinstance(dtype, ArrayType | MapType | StructType):
        return F.to_json(value)
    return value.cast("string")


def field(
    schema: StructType, path: str, default: str | int | float | bool | None = None,
    to: str | None = None,
) -> Column:
    """Field at a dotted path. A default replaces a missing value and also sets the
    type: a value that cannot be cast to it becomes the default as well."""
    if to is None and default is not None:
        to = _TYPE_OF_DEFAULT[type(default)]
    dtype = field_type(schema, path)
    if dtype is None:
        return F.lit(default).cast(to or "string")
    value = F.col(path)
    if to == "string":
        value = as_text(value, dtype)
    elif to is not None:
        value = value.try_cast(to)
    return value if default is None else F.coalesce(value, F.lit(default).cast(to))


def variant_field(
    record: Column | str, path: str, default: str | int | float | bool | None = None,
    to: str | None = None,
) -> Column:
    """Field at a dotted path of a VARIANT, whatever its shape; array elements by number, as in
    ``tasks[0].task_key``. As in :func:`field`, a default replaces a missing value, sets the
    type, and replaces a value that cannot be cast to it. Without type or default it is text,
    nested values as JSON."""
    if to is None:
        to = "string" if default is None else _TYPE_OF_DEFAULT[type(default)]
    record = F.col(record) if isinstance(record, str) else record
    value = F.try_variant_get(record, f"$.{path}", to)
    return value if default is None else F.coalesce(value, F.lit(default).cast(to))


def _conformed(value: Column, have: DataType, want: DataType) -> Column:
    if isinstance(want, StructType) and isinstance(have, StructType):
        fields = F.struct(
            *(
                (
                    _conformed(value[f.name], have[f.name].dataType, f.dataType)
                    if f.name in have.names
                    else F.lit(None).cast(f.dataType)
                ).alias(f.name)
                for f in want.fields
            )
        )
        return F.when(value.isNotNull(), fields)
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(value, lambda x: _conformed(x, have.elementType, want.elementType))
    return value if have == want else value.cast(want)


def conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and nested fields of ``schema``; those an export lacks are NULL.
    A table that has them all is returned as it is, so that a scan can still leave out fields."""
    if all(name in df.columns and df.schema[name].dataType == schema[name].dataType
           for name in schema.names):
        return df
    return df.select(
        *(
            _conformed(F.col(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name)
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def explode_fields(array: str, names: Sequence[str]) -> Column:
    """One row per element of an array of structs, with the named fields. Exploding the
    fields instead of the elements lets the scan leave out the other fields."""
    return F.explode(F.arrays_zip(*(F.col(f"{array}.{name}") for name in names)))
