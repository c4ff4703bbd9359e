"""Nested records: generic flattening to ``a_b_c`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for f in schema.fields:
        p = path + (f.name,)
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, p)
        else:
            yield p


def _ref(path: tuple[str, ...]) -> Column:
    c = F.col(f"`{path[0]}`")
    for name in path[1:]:
        c = c.getField(name)
    return c


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every struct leaf becomes a top-level column named by its path joined with ``sep``.

    Derived from the schema alone (a projection; no data is read to plan it).
    """
    return df.select(*[_ref(p).alias(sep.join(p)) for p in _leaves(df.schema)])
