"""Interval index: windows filed under calendar cells, so that a row meets only the windows that cover it.

A window is covered by cells of 1, 8, 64, .. days, the coarsest that fit inside it and finer ones at its ends: a
number that grows with the logarithm of its length. A row looks up one cell of each size that occurs, by equality.
Windows of a key that do not overlap meet a row once; the ends of windows shorter than a day share a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE, LEVELS = 8, 6  # up to cells of 8^5 days, 90 years
LATE_LEVEL = -1
ORIGIN = "1800-01-01"


def _day(ts: Column) -> Column:
    return F.datediff(ts, F.lit(ORIGIN).cast("date"))


def _range(level: int, first: Column, last: Column) -> Column:
    """Cells ``first .. last`` of a level as structs; none where the range is empty."""
    numbers = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda c: F.struct(F.lit(level).alias("level"), c.alias("cell")))


def cover(first: Column, last: Column) -> Column:
    """Cells that cover the days ``first .. last``, both included, each day once.

    The cells of a level that lie inside are ``low .. high``; those inside a cell of the next level are left to it.
    """
    low = lambda n: F.ceil(first / BASE ** n).cast("int")
    high = lambda n: (F.floor((last + 1) / BASE ** n) - 1).cast("int")
    parts = []
    for n in range(LEVELS - 1):
        coarser = high(n + 1) >= low(n + 1)
        parts.append(_range(n, low(n), F.when(coarser, low(n + 1) * BASE - 1).otherwise(high(n))))
        parts.append(_range(n, F.when(coarser, (high(n + 1) + 1) * BASE).otherwise(F.lit(1)), F.when(coarser, high(n)).otherwise(F.lit(0))))
    return F.concat(*parts, _range(LEVELS - 1, low(LEVELS - 1), high(LEVELS - 1)))


def window_cells(windows: DataFrame, previous: str, target: str, late: str | None = None) -> DataFrame:
    """``windows`` once for each cell that covers it, with ``_level`` and ``_cell``.

    Where ``late`` is given and not null the window is also filed under the late cell, which every row of its key looks up.
    """
    cells = cover(_day(F.col(previous)), _day(F.col(target)))
    if late:
        extra = F.array(F.struct(F.lit(LATE_LEVEL).alias("level"), F.lit(0).alias("cell")))
        cells = F.when(F.col(late).isNotNull(), F.concat(cells, extra)).otherwise(cells)
    return windows.withColumn("_c", F.explode(cells)).withColumns({"_level": F.col("_c.level"), "_cell": F.col("_c.cell")}).drop("_c")


def row_cells(rows: DataFrame, time: str, levels: list[int]) -> DataFrame:
    """``rows`` once for each of the levels that windows use, with the cell a row lies in."""
    day = _day(F.col(time))
    found = [F.struct(F.lit(n).alias("level"), (F.lit(0) if n == LATE_LEVEL else F.floor(day / BASE ** n).cast("int")).alias("cell")) for n in levels]
    return rows.withColumn("_c", F.explode(F.array(*found))).withColumns({"_rlevel": F.col("_c.level"), "_rcell": F.col("_c.cell")}).drop("_c")


def indexed_join(rows: DataFrame, windows: DataFrame, keys: list[tuple[str, str]], time: str, previous: str, target: str,
                 inside: Column, late_column: str | None, late: Column | None, row_id: str, broadcast_cells: int, salts: int = 16) -> DataFrame:
    """Rows with the windows that cover them, or for which they are late, by equality of key, level and cell.

    Cells are broadcast up to a counted number. Beyond it they are copied to salts and rows go to one salt by their id,
    so that a key with a third of all rows is spread.
    """
    cells = window_cells(windows, previous, target, late_column)
    counted = {r["_level"]: r["n"] for r in cells.groupBy("_level").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most seven rows
    probes = row_cells(rows, time, sorted(counted) or [0])
    on = (F.col("_rlevel") == F.col("_level")) & (F.col("_rcell") == F.col("_cell"))
    on = on & (F.when(F.col("_level") == LATE_LEVEL, late).otherwise(inside) if late is not None else inside)
    for left, right in keys:
        on = on & (F.col(left) == F.col(right))
    if sum(counted.values()) <= broadcast_cells:
        cells = F.broadcast(cells)
    else:
        probes = probes.withColumn("_rsalt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))
        cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("_rsalt") == F.col("_salt"))
    return probes.join(cells, on).drop("_rlevel", "_rcell", "_level", "_cell", "_rsalt", "_salt")
