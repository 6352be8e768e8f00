"""Declared fields of a table as Spark schemas, and checks on rows to be written."""

from __future__ import annotations

from collections.abc import Iterable
from enum import IntEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import metric


class DataType(IntEnum):
    """The type codes of declared fields."""

    BOOL = 1
    INT8 = 2
    INT16 = 3
    INT32 = 4
    INT64 = 5
    FLOAT = 10
    DOUBLE = 11
    STRING = 20
    VARCHAR = 21
    ARRAY = 22
    JSON = 23
    FLOAT_VECTOR = 101
    BOOL_VECTOR = 102
    SPARSE_VECTOR = 103


SIMPLE_TYPES = {
    DataType.BOOL: T.BooleanType(),
    DataType.INT8: T.ByteType(),
    DataType.INT16: T.ShortType(),
    DataType.INT32: T.IntegerType(),
    DataType.INT64: T.LongType(),
    DataType.FLOAT: T.FloatType(),
    DataType.DOUBLE: T.DoubleType(),
    DataType.STRING: T.StringType(),
    DataType.VARCHAR: T.StringType(),
    DataType.JSON: T.StringType(),
    DataType.FLOAT_VECTOR: T.ArrayType(T.FloatType()),
    DataType.BOOL_VECTOR: T.ArrayType(T.BooleanType()),
    DataType.SPARSE_VECTOR: T.MapType(T.IntegerType(), T.FloatType()),
}
VECTORS = (DataType.FLOAT_VECTOR, DataType.BOOL_VECTOR)
KEY_TYPES = (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)
# What a quick collection's key may be called, and its default length.
QUICK_ID_TYPES = {
    "str": DataType.VARCHAR,
    "string": DataType.VARCHAR,
    "int": DataType.INT64,
    "integer": DataType.INT64,
}
MAX_LENGTH = 16384
RESERVED = ("__snap", "__part", "__source", "part", "subpart")


def field(
    name: str,
    dtype: DataType | T.DataType,
    *,
    primary: bool = False,
    auto_id: bool = False,
    nullable: bool = False,
    dim: int | None = None,
    max_length: int | None = None,
    element_type: DataType | None = None,
    max_capacity: int | None = None,
) -> T.StructField:
    """One column. Any Spark type may be given instead of a ``DataType``."""
    if name in RESERVED:
        raise ValueError(f"{name!r} is reserved for storage")
    limits: dict = {}
    if isinstance(dtype, T.DataType):
        spark_type = dtype
    elif dtype == DataType.ARRAY:
        if element_type is None:
            raise ValueError(f"array field {name!r} needs element_type")
        if element_type in (DataType.ARRAY, DataType.VARCHAR, *VECTORS):
            raise ValueError(f"arrays of {element_type.name} are not supported")
        spark_type = T.ArrayType(SIMPLE_TYPES[element_type])
        if max_capacity is not None:
            limits["max_capacity"] = max_capacity
    else:
        spark_type = SIMPLE_TYPES[DataType(dtype)]
    if dtype == DataType.FLOAT_VECTOR and dim is None:
        raise ValueError(f"vector field {name!r} needs dim")
    if dtype == DataType.VARCHAR and max_length is None:
        raise ValueError(f"varchar field {name!r} needs max_length")
    if primary:
        allowed = isinstance(spark_type, KEY_TYPES) and dtype not in (DataType.STRING, DataType.JSON)
        if not allowed:
            raise ValueError(f"{dtype!r} cannot be a primary key")
        limits["pk"] = True
    if auto_id:
        if not isinstance(spark_type, (T.LongType, T.IntegerType)):
            raise ValueError("auto_id needs an integer key")
        limits["auto_id"] = True
    if dim is not None:
        limits["dim"] = dim
    if max_length is not None:
        limits["max_length"] = max_length
    return T.StructField(name, spark_type, nullable and not primary, limits)


def table_schema(fields: Iterable[T.StructField]) -> T.StructType:
    fields = list(fields)
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise ValueError("field names must differ")
    return T.StructType(fields)


def quick_schema(
    dimension: int | None,
    primary_field_name: str = "id",
    id_type: DataType | str = DataType.INT64,
    vector_field_name: str = "vector",
    auto_id: bool = False,
    max_length: int = MAX_LENGTH,
    metric_type: str = "l2",
) -> T.StructType:
    """Two columns: a key and a vector, searched by ``metric_type`` unless a search names another."""
    if isinstance(id_type, str):
        if id_type not in QUICK_ID_TYPES:
            raise ValueError(f"id_type must be one of {', '.join(QUICK_ID_TYPES)}")
        id_type = QUICK_ID_TYPES[id_type]
    allowed = (DataType.VARCHAR, DataType.BOOL, DataType.INT8, DataType.INT16, DataType.INT32, DataType.INT64)
    if id_type not in allowed:
        raise ValueError("id_type must be a VARCHAR or an integer type")
    if dimension is None:
        raise ValueError("a quick collection needs its dimension")
    length = max_length if id_type == DataType.VARCHAR else None
    key = field(primary_field_name, id_type, primary=True, auto_id=auto_id, max_length=length)
    vector = field(vector_field_name, DataType.FLOAT_VECTOR, dim=dimension, nullable=True)
    vector.metadata["metric"] = metric(metric_type).name
    return table_schema([key, vector])


def key_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.metadata.get("pk")]


def auto_id_column(schema: T.StructType) -> str | None:
    return next((f.name for f in schema if f.metadata.get("auto_id")), None)


def _guarded(f: T.StructField, value: Column) -> Column:
    """The value, or an error that fails the job, by the field's declared limits."""
    tests = []
    if not f.nullable:
        tests.append((value.isNotNull(), "must not be NULL"))
    if "dim" in f.metadata:
        whole = (F.size(value) == f.metadata["dim"]) & ~F.exists(value, lambda x: x.isNull())
        tests.append((value.isNull() | whole, f"needs {f.metadata['dim']} numbers"))
    if "max_length" in f.metadata:
        fits = F.char_length(value) <= f.metadata["max_length"]
        tests.append((value.isNull() | fits, f"is longer than {f.metadata['max_length']}"))
    if "max_capacity" in f.metadata:
        tests.append((value.isNull() | (F.size(value) <= f.metadata["max_capacity"]), "holds too many elements"))
    for ok, problem in tests:
        value = F.when(ok, value).otherwise(F.raise_error(F.lit(f"column {f.name} {problem}")).cast(f.dataType))
    return value


def conform(rows: DataFrame, schema: T.StructType, skip: Iterable[str] = ()) -> DataFrame:
    """Rows with exactly the schema's columns and types; absent nullable columns are NULL.

    A row that breaks a declared limit fails the job that reads the result.
    """
    unknown = set(rows.columns) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(sorted(unknown))}")
    out = []
    for f in schema:
        if f.name in skip:
            continue
        if f.name in rows.columns:
            value = F.col(f.name).cast(f.dataType)
        elif f.nullable:
            value = F.lit(None).cast(f.dataType)
        else:
            raise ValueError(f"column {f.name!r} is missing")
        out.append(_guarded(f, value).alias(f.name))
    return rows.select(*out)
