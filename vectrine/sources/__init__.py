from .partitioning import DEFAULT, MAXVALUE, HashPartition, KeyPartition, ListPartition, RangePartition
from .schema import DataType, field, quick_schema, table_schema
from .table import DuplicateKey, Table

__all__ = [
    "DEFAULT",
    "DataType",
    "DuplicateKey",
    "HashPartition",
    "KeyPartition",
    "ListPartition",
    "MAXVALUE",
    "RangePartition",
    "Table",
    "field",
    "quick_schema",
    "table_schema",
]
