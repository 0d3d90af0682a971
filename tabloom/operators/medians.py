"""Exact medians for columns of any size, overall or per class."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.defaults import DRIVER_CLASSES
from tabloom.errors import ValidationError
from tabloom.functions.columns import col, to_double
from tabloom.functions.local import local_table
from tabloom.scratch import materialize

# up to this many cells the built-in exact median (a hash map per group) is used
DIRECT_CELLS = 4_000_000
# below this many remaining values a search ends by sorting them in one group
FINAL_VALUES = 50_000
# rows of a group that the built-in median may hold
GROUP_ROWS = 1_000_000
GRID = 200
# values per column and group that bracket the middle rank; exact counts then tell where it is
SAMPLE = 100_000
# a pass leaves about a hundredth of what it looks at, so this is far beyond any need
MAX_PASSES = 60
ALL = "<all>"


def medians(
    df: DataFrame,
    columns: Sequence[str],
    by: str | None = None,
    *,
    rows: int | None = None,
    exact: bool = True,
    direct_cells: int = DIRECT_CELLS,
    final_values: int = FINAL_VALUES,
) -> dict[Any, dict[str, float | None]]:
    """``{group: {column: median}}``; the only group is ``None`` without ``by``. For a dictionary, so up to ``DRIVER_CLASSES`` groups; see :func:`class_medians`.

    The median of an even number of values is the mean of the two middle ones.
    Large tables are searched: quantiles of a sample bracket the middle rank, exact
    counts of all values say where it is, and the next pass looks only there. A
    poor sample costs a pass, never a wrong result. Nothing
    but a few numbers per (group, column) reaches the driver, and no task ever
    holds more than ``final_values`` values of a column.
    """
    if not columns:
        return {}
    if by is not None:
        df = df.where(col(by).isNotNull())
    keys = [col(by).alias("group")] if by is not None else [F.lit(ALL).alias("group")]
    if not exact:
        aggs = [F.percentile_approx(to_double(col(c)), 0.5, 10_000).alias(c) for c in columns]
        return _collect_wide(df.groupBy(*keys).agg(*aggs), columns, by)
    if rows is None:
        rows = df.count()
    if rows * len(columns) <= direct_cells:
        aggs = [F.median(to_double(col(c))).alias(c) for c in columns]
        return _collect_wide(df.groupBy(*keys).agg(*aggs), columns, by)
    values = df.select(*keys, *[to_double(col(c)).alias(f"v{i}") for i, c in enumerate(columns)])
    return _search(values, list(columns), by, final_values)


def class_medians(
    df: DataFrame, columns: Sequence[str], by: str, *, rows: int | None = None, direct_cells: int = DIRECT_CELLS, final_values: int = FINAL_VALUES
) -> DataFrame:
    """(group, m0, m1, ...): exact medians of any number of groups, as a stored table.

    Groups of up to ``GROUP_ROWS`` rows are what a task can hold, so the built-in median takes them, all in one pass. Larger ones, of which there are
    few by their size, are searched as in :func:`medians`, in batches whose numbers fit the driver.
    """
    values = df.where(col(by).isNotNull()).select(col(by).alias("group"), *[to_double(col(c)).alias(f"v{i}") for i, c in enumerate(columns)])
    k = range(len(columns))

    def direct(part: DataFrame) -> DataFrame:
        return part.groupBy("group").agg(*[F.median(f"v{i}").alias(f"m{i}") for i in k])

    if rows is None:
        rows = df.count()
    if rows * len(columns) <= direct_cells:
        return materialize(direct(values), "class-medians")
    large = materialize(values.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_ROWS).select("group"), "large-groups")
    many = large.count()
    if not many:
        return materialize(direct(values), "class-medians")
    # at most one row for each GROUP_ROWS rows
    parts = [direct(values.join(F.broadcast(large), "group", "left_anti"))]
    schema = T.StructType([values.schema["group"], *[T.StructField(f"m{i}", T.DoubleType()) for i in k]])
    batches = -(-2 * many // DRIVER_CLASSES) if many > DRIVER_CLASSES else 1
    for b in range(batches):
        some = large.where(F.pmod(F.xxhash64("group"), F.lit(batches)) == b)
        found = _search(values.join(F.broadcast(some), "group", "left_semi"), list(columns), by, final_values)
        parts.append(local_table(df.sparkSession, [(g, *[m[c] for c in columns]) for g, m in found.items()], schema))
    return materialize(reduce(DataFrame.unionByName, parts), "class-medians")


def _collect_wide(result: DataFrame, columns: Sequence[str], by: str | None):
    found = result.limit(DRIVER_CLASSES + 1).collect()
    if len(found) > DRIVER_CLASSES:
        raise ValidationError(f"{by} has more than {DRIVER_CLASSES} classes")
    return {(r["group"] if by is not None else None): {c: r[c] for c in columns} for r in found}


class _Bounds:
    """Numbers per (group, column), put beside every row of the group."""

    def __init__(self, values: DataFrame, by: str | None):
        self._values = values
        self._by = by

    def beside(self, names: Sequence[str], numbers: dict[tuple, tuple]) -> DataFrame:
        """``<name><i>`` columns; null where a (group, column) has no numbers."""
        width = [f for f in self._values.columns if f != "group"]
        places = [(f"{name}{i}", n, i) for i in range(len(width)) for n, name in enumerate(names)]
        groups = list(dict.fromkeys(g for g, _ in numbers))
        cells = [[numbers[(g, i)][n] if (g, i) in numbers else None for _, n, i in places] for g in groups]
        if self._by is None:
            return self._values.select("*", *[F.lit(v).cast("double").alias(p[0]) for p, v in zip(places, cells[0])])
        fields = [self._values.schema["group"], *[T.StructField(p[0], T.DoubleType()) for p in places]]
        table = local_table(self._values.sparkSession, [(g, *c) for g, c in zip(groups, cells)], T.StructType(fields))
        # one row per class, at most DRIVER_CLASSES
        return self._values.join(F.broadcast(table), "group")


def _search(values: DataFrame, columns: list[str], by: str | None, final_values: int):
    k = range(len(columns))
    bounds = _Bounds(values, by)
    counted = values.groupBy("group").agg(*[F.count(f"v{i}").alias(f"n{i}") for i in k]).limit(DRIVER_CLASSES + 1).collect()
    if len(counted) > DRIVER_CLASSES:
        raise ValidationError(f"{by} has more than {DRIVER_CLASSES} classes")
    n = {(r["group"], i): r[f"n{i}"] for r in counted for i in k if r[f"n{i}"]}
    # interval holding the lower middle value, whether its ends belong to it (infinite values do), and the rank inside
    searches = {key: dict(low=-math.inf, high=math.inf, low_in=1, high_in=1, rank=(m - 1) // 2, inside=m) for key, m in n.items()}
    lower: dict[tuple, float] = {}

    def inside(i: int) -> Column:
        v, low, high = F.col(f"v{i}"), F.col(f"low{i}"), F.col(f"high{i}")
        above = (v > low) | ((F.col(f"low_in{i}") == 1) & (v == low))
        return above & ((v < high) | ((F.col(f"high_in{i}") == 1) & (v == high)))

    def rows(searches: dict, extra: dict | None = None) -> DataFrame:
        numbers = {
            key: (s["low"], s["high"], s["low_in"], s["high_in"], min(1.0, SAMPLE / s["inside"]), float(s["rank"]), *(extra or {}).get(key, ()))
            for key, s in searches.items()
        }
        return bounds.beside(["low", "high", "low_in", "high_in", "share", "rank", *(["e", "f"] if extra else [])], numbers)

    passes = 0
    while searches:
        passes += 1
        if passes > MAX_PASSES:
            raise RuntimeError(f"the medians of {sorted({columns[i] for _, i in searches})} did not settle in {MAX_PASSES} passes")
        small = {key: s for key, s in searches.items() if s["inside"] <= final_values}
        large = {key: s for key, s in searches.items() if key not in small}
        searches = {}
        if small:
            lists = [F.sort_array(F.collect_list(F.when(inside(i), F.col(f"v{i}")))).alias(f"a{i}") for i in k]
            ranks = [F.max(f"rank{i}").cast("int").alias(f"r{i}") for i in k]
            near = rows(small).where(reduce(or_, [inside(i) for i in k]))
            found = near.groupBy("group").agg(*lists, *ranks)
            for r in found.select("group", *[F.get(f"a{i}", F.col(f"r{i}")).alias(f"a{i}") for i in k]).collect():
                lower.update({(r["group"], i): r[f"a{i}"] for i in k if (r["group"], i) in small})
        if not large:
            break
        grid = [j / GRID for j in range(GRID + 1)]
        drawn = [inside(i) & (F.col("r") < F.col(f"share{i}")) for i in k]
        sampled = rows(large).withColumn("r", F.rand(passes)).where(reduce(or_, drawn))
        quantiles = sampled.groupBy("group").agg(
            *[F.percentile_approx(F.when(d, F.col(f"v{i}")), grid, 4_000).alias(f"q{i}") for i, d in zip(k, drawn)]
        )
        edges = {}
        for r in quantiles.collect():
            for i in k:
                s = large.get((r["group"], i))
                if s is not None and r[f"q{i}"]:
                    at = s["rank"] * GRID // s["inside"]
                    edges[(r["group"], i)] = (r[f"q{i}"][max(0, at - 1)], r[f"q{i}"][min(GRID, at + 2)])
        searches.update({key: s for key, s in large.items() if key not in edges})  # an empty sample: try again
        if not edges:
            continue
        counts = []
        for i in k:
            v, e, f = F.col(f"v{i}"), F.col(f"e{i}"), F.col(f"f{i}")
            counts += [
                F.count_if(inside(i) & (v < e)).alias(f"below{i}"),
                F.count_if(inside(i) & (v == e)).alias(f"first{i}"),
                F.count_if(inside(i) & (v > e) & (v < f)).alias(f"between{i}"),
                F.count_if(inside(i) & (v == f) & (f > e)).alias(f"last{i}"),
            ]
        counted = rows({key: large[key] for key in edges}, edges).groupBy("group").agg(*counts).collect()
        for r in counted:
            for i in k:
                key = (r["group"], i)
                if key in edges:
                    _narrow(key, large[key], edges[key], [r[f"{p}{i}"] for p in ("below", "first", "between", "last")], searches, lower)

    upper = _upper(bounds, n, lower, len(columns))
    groups = {g for g, _ in n} if by is not None else {ALL}
    return {
        (g if by is not None else None): {
            c: (lower[(g, i)] + upper[(g, i)]) / 2 if (g, i) in lower else None for i, c in enumerate(columns)
        }
        for g in groups
    }


def _narrow(key, search: dict, edges: tuple, parts: list[int], searches: dict, lower: dict) -> None:
    """Go on in the part that holds the rank: below, at the first edge, between, at the last edge, above."""
    below, first, between, last = parts
    above = search["inside"] - sum(parts)
    lo, hi = edges
    rank = search["rank"]
    for size, value, low, high, low_in, high_in in (
        (below, None, search["low"], lo, search["low_in"], 0), (first, lo, 0, 0, 0, 0), (between, None, lo, hi, 0, 0),
        (last, hi, 0, 0, 0, 0), (above, None, hi, search["high"], 0, search["high_in"]),
    ):
        if rank < size:
            if value is not None:
                lower[key] = value
            else:
                searches[key] = dict(low=low, high=high, low_in=low_in, high_in=high_in, rank=rank, inside=size)
            return
        rank -= size


def _upper(bounds: _Bounds, n: dict, lower: dict, width: int) -> dict:
    """The upper middle values: the lower one again, or the next larger value."""
    upper = dict(lower)
    even = {key: (v,) for key, v in lower.items() if n[key] % 2 == 0}
    if even:
        aggs = []
        for i in range(width):
            v, found = F.col(f"v{i}"), F.col(f"found{i}")
            aggs += [F.count_if(v <= found).alias(f"upto{i}"), F.min(F.when(v > found, v)).alias(f"next{i}")]
        for r in bounds.beside(["found"], even).groupBy("group").agg(*aggs).collect():
            for i in range(width):
                key = (r["group"], i)
                if key in even and r[f"upto{i}"] <= n[key] // 2:
                    upper[key] = r[f"next{i}"]
    return upper
