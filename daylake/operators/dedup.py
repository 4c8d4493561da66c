"""One row per key, the latest one wins.

Written as ``row_number() over (partition by keys order by ...) = 1``.
Catalyst turns this into a WindowGroupLimit on *both* sides of the single
hash shuffle: every map task keeps only its best row per key before the
exchange, so a key that holds a third of all rows still sends one row per
task through the shuffle. A sort followed by ``dropDuplicates`` would need
two shuffles and does not promise which row survives.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RANK = "__rank"


def _order(spec: str) -> tuple[str, bool]:
    """``"col"`` / ``"col asc"`` / ``"col desc"`` -> (name, descending)."""
    parts = spec.split()
    if len(parts) == 2 and parts[1].lower() in ("asc", "desc"):
        return parts[0], parts[1].lower() == "desc"
    return spec, False


def _holds(kind: DataType, types: tuple) -> bool:
    if isinstance(kind, types):
        return True
    if isinstance(kind, ArrayType):
        return _holds(kind.elementType, types)
    if isinstance(kind, MapType):
        return _holds(kind.keyType, types) or _holds(kind.valueType, types)
    return isinstance(kind, StructType) and any(_holds(f.dataType, types) for f in kind.fields)


def _orderable(column: Column, kind: DataType) -> Column:
    """The column in a form that has an order: arrays and structs have one; a
    map is ordered by its sorted entries, anything that still holds a map or a
    variant by its JSON text."""
    if isinstance(kind, MapType) and not _holds(kind.valueType, (MapType, VariantType)):
        return F.sort_array(F.map_entries(column))
    if _holds(kind, (MapType, VariantType)):
        return F.to_json(F.struct(column.alias("v")))
    return column


def order_columns(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  tie_break: bool = True) -> list[Column]:
    """Sort order for the survivor; with ``tie_break`` every other column is
    appended (descending, NULLs last) so that the order is total (D5)."""
    cols: list[Column] = []
    named = set(keys)
    for spec in order_by:
        name, desc = _order(spec)
        named.add(name)
        cols.append(F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_first())
    if tie_break:
        for field in df.schema.fields:
            if field.name not in named:
                cols.append(_orderable(F.col(field.name), field.dataType).desc_nulls_last())
    return cols


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   tie_break: bool = True) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (e.g.
    ``["year_month_day desc"]``). NULL keys form one group, as in
    ``dropDuplicates``."""
    w = Window.partitionBy(*keys).orderBy(*order_columns(df, keys, order_by, tie_break))
    return (df.withColumn(_RANK, F.row_number().over(w))
              .where(F.col(_RANK) == 1)
              .drop(_RANK))
