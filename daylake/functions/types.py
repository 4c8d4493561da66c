"""Type reconciliation of a source with a table (K4).

``widest`` is the least type that holds every value of both: the join of a
lattice without lossy steps. The source is cast to it before anything is
written; if it is wider than the table's type, the table's column is widened;
if there is none (text and numbers, long and double, timestamps with and
without zone), the upsert is refused before any write.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, NullType, ShortType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)

# Decimal digits that hold any value of the type, narrowest type first.
DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
_RANK = list(DIGITS)


def widest(a: DataType, b: DataType) -> DataType | None:
    """The least type that holds both without loss; None if there is none."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StringType) and isinstance(b, StringType):     # char and varchar among them
        return StringType()
    if a in _RANK and b in _RANK:
        return _RANK[max(_RANK.index(a), _RANK.index(b))]
    for x, y in ((a, b), (b, a)):
        if x in _RANK and isinstance(y, DecimalType):
            return _decimal(max(DIGITS[x], y.precision - y.scale), y.scale)
        if x in _RANK[:2] and isinstance(y, FloatType):
            return FloatType()
        if (x in _RANK[:3] or isinstance(x, FloatType)) and isinstance(y, DoubleType):
            return DoubleType()
        if x == IntegerType() and isinstance(y, FloatType):
            return DoubleType()
        if isinstance(x, DateType) and isinstance(y, (TimestampType, TimestampNTZType)):
            return y
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        kind = widest(a.elementType, b.elementType)
        return kind and ArrayType(kind, True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, value = widest(a.keyType, b.keyType), widest(a.valueType, b.valueType)
        return MapType(key, value, True) if key and value else None
    if isinstance(a, StructType) and isinstance(b, StructType) and a.names == b.names:
        kinds = [widest(x.dataType, y.dataType) for x, y in zip(a, b)]
        return StructType([StructField(n, k, True) for n, k in zip(a.names, kinds)]) if all(kinds) else None
    return None


def _decimal(whole: int, scale: int) -> DecimalType | None:
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def read_in_place(old: DataType, new: DataType) -> bool:
    """Does Spark's Parquet reader give files of the ``old`` type as ``new``?
    Otherwise the table's old rows are rewritten with the new type."""
    if old == new:
        return True
    if old in _RANK:
        return new in _RANK or isinstance(new, DoubleType) and old in _RANK[:3]
    return (isinstance(old, FloatType) and isinstance(new, DoubleType)
            or isinstance(old, DateType) and isinstance(new, TimestampNTZType)
            or isinstance(old, StringType) and isinstance(new, StringType))


def reconcile(table: StructType, source: StructType, partitions: list[str],
              name: str = "the table") -> tuple[StructType, list[str]]:
    """The schema that holds the table and the source, partition columns last,
    and the columns whose old files must be rewritten for it.

    A column the table has not is added; one the source has not, a partition
    column of another type or types without a common one raise ValueError."""
    given = {f.name.lower(): f for f in source.fields}
    present = {f.name.lower() for f in table.fields}
    if missing := sorted(present - set(given)):
        raise ValueError(f"{name}: the source has no column {', '.join(missing)}")
    fields, stale = [], []
    for f in table.fields:
        other = given[f.name.lower()].dataType
        kind = widest(f.dataType, other)
        if kind is None or (f.name in partitions and kind != f.dataType):
            raise ValueError(f"{name}: column {f.name} is {f.dataType.simpleString()}, "
                             f"the source has {other.simpleString()}")
        fields.append(StructField(f.name, kind, True))
        if not read_in_place(f.dataType, kind):
            stale.append(f.name)
    new = [StructField(f.name, f.dataType, True) for f in source.fields if f.name.lower() not in present]
    if void := [f.name for f in new if isinstance(f.dataType, NullType)]:
        raise ValueError(f"{name}: new columns without a type: {', '.join(void)}")
    data = [f for f in fields if f.name not in partitions]
    return StructType([*data, *new, *[f for f in fields if f.name in partitions]]), stale


__all__ = ["widest", "read_in_place", "reconcile"]
