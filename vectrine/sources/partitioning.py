"""Partition rules: which named partition a row belongs to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAXVALUE = "MAXVALUE"
DEFAULT = "DEFAULT"
PART, SUBPART = "part", "subpart"
# How key parts are joined before hashing, and what stands for NULL.
KEY_SEPARATOR = "\u0001"
NULL_MARKER = "\u0000"


def _is_word(value, word: str) -> bool:
    return isinstance(value, str) and value.upper() == word


def _plain(value):
    """A bound as a JSON-safe value; dates and timestamps become their text."""
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


class Partition:
    """A rule with at most one second-level rule, the same below every partition."""

    kind: str
    sub: Partition | None = None

    def label(self) -> Column:
        """The partition name of a row, NULL when none takes it."""
        raise NotImplementedError

    def to_dict(self) -> dict:
        raise NotImplementedError

    def by(self, sub: Partition) -> Partition:
        """Add the second level."""
        if sub.sub is not None:
            raise ValueError("partitions nest at most two levels deep")
        self.sub = sub
        return self

    def levels(self) -> list[str]:
        return [PART] if self.sub is None else [PART, SUBPART]

    def assign(self, df: DataFrame) -> DataFrame:
        """Append the ``part`` (and ``subpart``) columns."""
        labels = {PART: self.label()}
        if self.sub is not None:
            labels[SUBPART] = self.sub.label()
        return df.withColumns(labels)


class _Listed(Partition):
    """Rules with declared values: by one expression, or by columns."""

    def __init__(
        self, parts: Sequence[tuple[str, object]], *, expr: str | None = None, columns: Sequence[str] | None = None
    ):
        if (expr is None) == (columns is None):
            raise ValueError("give either expr or columns")
        self.parts = [(name, _plain(value)) for name, value in parts]
        self.expr = expr
        self.columns = list(columns) if columns is not None else None

    def _values(self) -> list[Column]:
        return [F.expr(self.expr)] if self.expr is not None else [F.col(c) for c in self.columns]

    def _takes(self, bound) -> Column:
        raise NotImplementedError

    def label(self) -> Column:
        result = None
        for name, bound in self.parts:
            test = self._takes(bound)
            result = F.when(test, F.lit(name)) if result is None else result.when(test, F.lit(name))
        return result

    def to_dict(self) -> dict:
        return {
            "kind": self.kind,
            "parts": self.parts,
            "expr": self.expr,
            "columns": self.columns,
            "sub": self.sub.to_dict() if self.sub else None,
        }


class RangePartition(_Listed):
    """``[("p0", 100), ("p1", MAXVALUE)]``: exclusive upper bounds, in ascending order.

    Several columns compare as a tuple, ``("p0", (2020, 7))``. NULL belongs to
    the MAXVALUE partition, if there is one.
    """

    kind = "range"

    def __init__(self, parts, **rule):
        super().__init__(parts, **rule)
        bounds = [[(1, 0) if _is_word(v, MAXVALUE) else (0, v) for v in (b if isinstance(b, list) else [b])] for _, b in self.parts]
        for (name, _), low, high in zip(self.parts[1:], bounds, bounds[1:]):
            if not low < high:
                raise ValueError(f"the bound of partition {name!r} is not above the one before")

    def _takes(self, bound) -> Column:
        bounds = bound if isinstance(bound, list) else [bound]
        values = self._values()
        if len(bounds) == 1 and _is_word(bounds[0], MAXVALUE):
            return F.lit(True)
        if len(bounds) != len(values):
            raise ValueError(f"{len(values)} values but {len(bounds)} bounds")
        below = F.lit(False)
        for value, limit in reversed(list(zip(values, bounds))):
            if _is_word(limit, MAXVALUE):
                below = F.lit(True)
            else:
                below = (value < F.lit(limit)) | ((value == F.lit(limit)) & below)
        return below


class ListPartition(_Listed):
    """``[("p0", [1, 2, 3]), ("p1", DEFAULT)]``: the values of each partition.

    Values of several columns are tuples. NULL belongs to DEFAULT, if there is one.
    """

    kind = "list"

    def __init__(self, parts, **how):
        super().__init__(sorted(parts, key=lambda p: _is_word(p[1], DEFAULT)), **how)

    def _takes(self, bound) -> Column:
        if _is_word(bound, DEFAULT):
            return F.lit(True)
        wanted = bound if isinstance(bound, list) else [bound]
        values = self._values()
        if len(values) == 1:
            return values[0].isin([w[0] if isinstance(w, list) else w for w in wanted])
        tuples = [reduce(and_, [v == F.lit(x) for v, x in zip(values, w, strict=True)]) for w in wanted]
        return reduce(lambda a, b: a | b, tuples)


class _Hashed(Partition):
    """Rules that spread rows over a number of partitions; a count wins over names."""

    def __init__(self, names: Sequence[str] | None, count: int | None):
        if names is None and count is None:
            raise ValueError("give the number of partitions or their names")
        self.names = [f"p{i}" for i in range(count)] if count is not None else list(names)

    def _text(self) -> Column:
        raise NotImplementedError

    def bucket(self) -> Column:
        """The first 32 bits of the MD5 of the value's text, modulo the partitions."""
        head = F.conv(F.substring(F.md5(self._text()), 1, 8), 16, 10).cast("long")
        return F.pmod(head, F.lit(len(self.names))).cast("int")

    def label(self) -> Column:
        return F.get(F.array(*[F.lit(n) for n in self.names]), self.bucket())


class HashPartition(_Hashed):
    """By the hash of one expression."""

    kind = "hash"

    def __init__(self, expr: str, names: Sequence[str] | None = None, count: int | None = None):
        super().__init__(names, count)
        self.expr = expr

    def _text(self) -> Column:
        return F.coalesce(F.expr(self.expr).cast("string"), F.lit(NULL_MARKER))

    def to_dict(self) -> dict:
        return {"kind": self.kind, "expr": self.expr, "names": self.names, "sub": self.sub.to_dict() if self.sub else None}


class KeyPartition(_Hashed):
    """By the hash of several columns."""

    kind = "key"

    def __init__(self, columns: Sequence[str], names: Sequence[str] | None = None, count: int | None = None):
        super().__init__(names, count)
        self.columns = list(columns)

    def _text(self) -> Column:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARKER)) for c in self.columns]
        return F.concat_ws(KEY_SEPARATOR, *parts)

    def to_dict(self) -> dict:
        return {
            "kind": self.kind,
            "columns": self.columns,
            "names": self.names,
            "sub": self.sub.to_dict() if self.sub else None,
        }


def from_dict(spec: dict) -> Partition:
    """The rule described by ``to_dict``."""
    kind = spec["kind"]
    if kind in ("range", "list"):
        rule_type = RangePartition if kind == "range" else ListPartition
        rule = rule_type([tuple(p) for p in spec["parts"]], expr=spec["expr"], columns=spec["columns"])
    elif kind == "hash":
        rule = HashPartition(spec["expr"], spec["names"])
    else:
        rule = KeyPartition(spec["columns"], spec["names"])
    return rule.by(from_dict(spec["sub"])) if spec["sub"] else rule
