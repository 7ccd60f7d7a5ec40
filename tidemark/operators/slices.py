"""Ordered windows over one very long video: a segmented prefix scan.

A key's rows are cut into slices of its order (time, or a row number). Windows run inside
slices, which tasks share out; each slice is reduced to a carry (its sum, its greatest
value, its last row), the carries of a key are scanned in slice order, and what comes from
slices before is put together with the value inside. Rows are exchanged by (key, slice);
carries of the input's own columns are added up before that in the tasks that read it.
Only carries, one row a slice, are ordered by key alone.

Rows whose order is null stand first, as in a window. Rows of one order value share a
slice, so a slice holds what a stretch of ``width`` can hold. Rows with a null key meet no carry;
those of a null key are one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a slice.
WIDTH = 600.0
_SLICE = "__slice"


class Scan:
    """Windows over all rows of a key in the order (at, *tie); each method adds a column to ``rows``."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], at: str, *tie: str, width: float = WIDTH):
        self.keys, self.order = list(keys), [at, *tie]
        self.inside = Window.partitionBy(*keys, _SLICE).orderBy(*self.order)
        self.upto = self.inside.rowsBetween(Window.unboundedPreceding, -1)
        self.slices = Window.partitionBy(*keys).orderBy(_SLICE)
        self.before = self.slices.rowsBetween(Window.unboundedPreceding, -1)
        first, unknown = F.lit(-(2**63)), F.lit(False)
        for k in keys:
            unknown = unknown | F.col(k).isNull()
        number = F.when(~unknown, F.coalesce(F.floor(F.col(at) / F.lit(float(width))).cast("bigint"), first)).otherwise(first)
        self.read = rows.withColumn(_SLICE, number)
        self.rows = self.read.repartition(*keys, _SLICE)

    def done(self) -> DataFrame:
        return self.rows.drop(_SLICE)

    def _carry(self, source: DataFrame, carried: Column, scanned: Column) -> None:
        """Add the scanned carry of each row's slice as ``__c``."""
        reduced = source.groupBy(*self.keys, _SLICE).agg(carried.alias("__s"))
        self.rows = self.rows.join(reduced.select(*self.keys, _SLICE, scanned.alias("__c")), [*self.keys, _SLICE], "left").select(*self.rows.columns, "__c")

    def _put(self, name: str, value: Column) -> Scan:
        self.rows = self.rows.withColumn(name, value).drop("__c")
        return self

    def with_column(self, name: str, value: Column) -> Scan:
        """A column made from those of the same row; scans of it are ``total_before`` alone."""
        self.rows = self.rows.withColumn(name, value)
        return self

    def total_before(self, name: str, column: str) -> Scan:
        """Sum of a column over all rows before; 0 at a key's first row."""
        self._carry(self.rows, F.sum(column), F.sum("__s").over(self.before))
        return self._put(name, F.coalesce("__c", F.lit(0)) + F.coalesce(F.sum(column).over(self.upto), F.lit(0)))

    def greatest_before(self, name: str, value: Column) -> Scan:
        """The greatest value (of the input's columns) of all rows before; null at a key's first row."""
        self._carry(self.read, F.max(value), F.max("__s").over(self.before))
        return self._put(name, F.greatest("__c", F.max(value).over(self.upto)))

    def last_before(self, name: str, value: Column, skip_nulls: bool = False) -> Scan:
        """The value (of the input's columns) of the row before or, with ``skip_nulls``, the last one that is not null."""
        held = F.struct(value.alias("x"))
        held = F.when(value.isNotNull(), held) if skip_nulls else held
        self._carry(self.read, F.max_by(held, F.when(held.isNotNull(), F.struct(*self.order))), F.last("__s", ignorenulls=True).over(self.before))
        return self._put(name, F.coalesce(F.last(held, ignorenulls=True).over(self.upto), "__c")["x"])

    def first_after(self, name: str, value: Column) -> Scan:
        """The value (of the input's columns) of the row after; null at a key's last row."""
        held = F.struct(value.alias("x"))
        self._carry(self.read, F.min_by(held, F.struct(*self.order)), F.lead("__s").over(self.slices))
        return self._put(name, F.coalesce(F.lead(held).over(self.inside), "__c")["x"])
