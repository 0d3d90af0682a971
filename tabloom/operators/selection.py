"""Exact, repeatable choice of a number of rows per class.

Rows are ordered by a hash of seed and key. Counting hash prefixes finds, per
class, the prefix in which the quota is reached; looking only at the rows with
that prefix finds the last chosen hash. The choice itself is then a filter:
the table is never sorted or shuffled, however uneven the classes are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.defaults import DRIVER_CLASSES, SEED
from tabloom.errors import ValidationError
from tabloom.functions.columns import col, row_hash, whole_row_hash
from tabloom.functions.local import local_table
from tabloom.operators.profiling import checked_counts
from tabloom.scratch import materialize

# hex digits added to the counted prefix per pass
PREFIX_DIGITS = 4
# rows sharing the deciding prefix that one task may order; more are counted by a longer prefix first
NEAR_ROWS = 1_000_000
COPIES_PER_ROW = 100_000


# before, at or behind the last chosen hash; a null _cut marks a class of which nothing is chosen
PLACE = "cast(case when _hash < _cut then -1 when _hash = _cut then 0 else 1 end as tinyint)"


class Selection:
    """The chosen rows of a table and the others; ``counts`` are the rows per class."""

    def __init__(self, marked: DataFrame, columns: list[str], counts: dict | DataFrame, quotas: dict | DataFrame, whole: bool, copies: int):
        self._marked = marked
        self._columns = columns
        self.counts = counts
        self.quotas = quotas
        # whether every class takes all rows with its last hash, and the most rows that share one
        self._whole = whole
        self._copies = copies

    def chosen(self) -> DataFrame:
        if self._whole:
            return self._rows("_place <= 0")
        return self._rows("_place < 0").unionAll(self._copies_at_cut(F.max("_need")))

    def others(self) -> DataFrame:
        rows = self._rows("_place > 0")
        return rows if self._whole else rows.unionAll(self._copies_at_cut(F.count("*") - F.max("_need")))

    def others_with_hashes(self) -> DataFrame:
        """For another choice among them by the same keys and seed; keys tell all rows apart, so none are copies."""
        return self._rows("_place > 0", "_hash")

    def _rows(self, condition: str, *more: str) -> DataFrame:
        return self._marked.where(condition).select(*[col(c) for c in self._columns], *more)

    def _copies_at_cut(self, wanted: Column) -> DataFrame:
        """Rows with the last hash are equal, so ``wanted`` copies are made from one of them."""
        names = [col(c) for c in self._columns]
        step = COPIES_PER_ROW
        rows = self._marked.where("_place = 0").groupBy(*names).agg(wanted.alias("_wanted")).where("_wanted > 0")
        parts = rows.withColumn("_part", F.explode(F.expr(f"sequence(0L, (_wanted - 1) div {step})")))
        if self._copies > step:
            parts = parts.repartition(F.col("_part"))
        size = F.expr(f"least({step}, _wanted - _part * {step})")
        return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size))).select(*names)


def with_hashes(df: DataFrame, keys: Sequence[str] | None = None, seed: int = SEED) -> DataFrame:
    """The rows stored with their hashes.

    A choice reads its rows some four times, and to make a hash costs several times what it does to read one.
    """
    return materialize(df.withColumn("_hash", _hash(df.columns, keys, seed)), "hashed")


def _hash(columns: Sequence[str], keys: Sequence[str] | None, seed: int) -> Column:
    """16 bytes, in the order of their digits."""
    return F.unhex(row_hash(seed, keys) if keys else whole_row_hash(seed, columns))


def take_per_group(
    df: DataFrame,
    group: str,
    quotas: Callable[[dict], dict],
    keys: Sequence[str] | None = None,
    seed: int = SEED,
    table_quotas: Callable[[DataFrame], DataFrame] | None = None,
    hashed: bool = False,
) -> Selection:
    """Choose exactly ``quotas(class counts)[class]`` rows of every class.

    ``keys`` name columns that identify a row; without them whole rows are
    hashed and equal rows are interchangeable. Up to ``DRIVER_CLASSES`` classes their numbers pass through the driver and are broadcast;
    beyond that all of them stay tables, with ``table_quotas`` from (_class, n) to (_class, _quota), and the same rows are chosen.

    ``hashed`` says that ``df`` comes from :func:`with_hashes` with these keys and this seed; the hashes are no part of the chosen rows.
    """
    columns = [c for c in df.columns if not (hashed and c == "_hash")]
    h = None if hashed else _hash(columns, keys, seed)
    marked = df if hashed else df.withColumn("_hash", h)

    prefixes = _count_prefixes(marked, group, PREFIX_DIGITS).persist()  # 16^4 rows per class
    try:
        found = prefixes.groupBy("_class").agg(F.sum("_n").alias("n")).limit(DRIVER_CLASSES + 1).collect()
        if len(found) > DRIVER_CLASSES:
            if table_quotas is None:
                raise ValidationError(f"{group} has more than {DRIVER_CLASSES} classes")
            return _take_by_table(df, h, prefixes, group, table_quotas, keys)
        counts = checked_counts({r["_class"]: r["n"] for r in found}, group)
        wanted = quotas(counts)
        for c, q in wanted.items():
            if not 0 <= q <= counts.get(c, 0):
                raise ValidationError(f"class {c} has {counts.get(c, 0)} rows, {q} wanted")
        edges = _edges(prefixes, {c: q for c, q in wanted.items() if q > 0})
    finally:
        prefixes.unpersist()
    cuts = _cuts(marked, group, edges) if edges else []

    if keys and any(need != same for _, _, need, same in cuts):
        raise ValidationError(f"{list(keys)} do not identify rows")
    table = local_table(
        df.sparkSession,
        [(c, cut, need) for c, cut, need, _ in cuts],
        T.StructType(
            [
                T.StructField("_class", df.schema[group].dataType),
                T.StructField("_cut", T.BinaryType()),
                T.StructField("_need", T.LongType()),
            ]
        ),
    )
    # one row per class, at most DRIVER_CLASSES
    joined = marked.join(F.broadcast(table), col(group) == F.col("_class"), "left")
    whole = all(need == same for _, _, need, same in cuts)
    return Selection(joined.withColumn("_place", F.expr(PLACE)), columns, counts, wanted, whole, max((same for _, _, _, same in cuts), default=0))


def _take_by_table(
    df: DataFrame, h: Column | None, prefixes: DataFrame, group: str, quotas: Callable[[DataFrame], DataFrame], keys: Sequence[str] | None
) -> Selection:
    """The same search for all classes at once, with tables instead of numbers on the driver.

    The table may be a costly one, so its rows are stored once, and again with their place at the end, as both sides of a split read them. Hashes are made
    where they are wanted. Without ``h`` the rows are stored with them.
    """
    hashed = ["_hash"] if h is None else []
    columns = [c for c in df.columns if c not in hashed]
    prefixes = materialize(prefixes, "class-prefixes")
    counts = materialize(prefixes.groupBy("_class").agg(F.sum("_n").alias("n")), "class-counts")
    nulls = counts.where("_class is null").first()
    if nulls:
        raise ValidationError(f"{group} has {nulls['n']} rows without a class")
    wanted = materialize(quotas(counts).select("_class", F.col("_quota").cast("long").alias("_quota")), "class-quotas")
    bad = counts.join(wanted, "_class").where("_quota < 0 or _quota > n").first()
    if bad:
        raise ValidationError(f"class {bad['_class']} has {bad['n']} rows, {bad['_quota']} wanted")

    stored = df if hashed else materialize(df, "class-rows")
    h = F.col("_hash") if hashed else h

    def near(edges: DataFrame, digits: int) -> DataFrame:
        # the prefix is a key of the join but no column of the rows
        rows = stored.select(col(group).alias("_of"), h.alias("_hash"))
        met = rows.join(edges.select("_class", "_prefix", "_rest"), (F.col("_of") == F.col("_class")) & (_prefix(digits) == F.col("_prefix")))
        return met.select("_class", "_prefix", "_rest", "_hash")

    digits = PREFIX_DIGITS
    edges = materialize(_edge_table(prefixes, wanted.where("_quota > 0")), "class-edges")
    while digits < 16 and (edges.agg(F.max("_n")).first()[0] or 0) > NEAR_ROWS:
        longer = near(edges, digits).select("_class", "_hash")
        digits += PREFIX_DIGITS
        rest = edges.select("_class", F.col("_rest").alias("_quota"))
        edges = materialize(_edge_table(_count_prefixes(longer, "_class", digits), rest), "class-edges")
    cuts = materialize(_cut_table(near(edges, digits)), "class-cuts")
    facts = cuts.agg(F.bool_and(F.expr("_need = _same")).alias("whole"), F.max("_same").alias("copies")).first()
    whole = facts["whole"] is not False
    if keys and not whole:
        raise ValidationError(f"{list(keys)} do not identify rows")
    joined = stored.join(cuts.select(F.col("_class").alias("_of"), F.col("_hash").alias("_cut"), "_need"), col(group) == F.col("_of"), "left")
    joined = joined.withColumn("_hash", h)  # not shuffled
    placed = materialize(joined.select(*[col(c) for c in columns], *hashed, F.expr(PLACE).alias("_place"), "_need"), "class-places")
    return Selection(placed, columns, counts, wanted, whole, facts["copies"] or 0)


def _prefix(digits: int) -> Column:
    """The first digits of a hash, two to a byte."""
    return F.substring("_hash", 1, digits // 2)


def _count_prefixes(marked: DataFrame, group: str, digits: int) -> DataFrame:
    return marked.groupBy(col(group).alias("_class"), _prefix(digits).alias("_prefix")).agg(F.count("*").alias("_n"))


def _edges(prefixes: DataFrame, quotas: dict) -> list[tuple]:
    """Per class: the prefix in which the quota is reached, what is still needed there, its rows."""
    if not quotas:
        return []
    table = local_table(
        prefixes.sparkSession,
        list(quotas.items()),
        T.StructType([prefixes.schema["_class"], T.StructField("_quota", T.LongType())]),
    )
    return [tuple(r) for r in _edge_table(prefixes, F.broadcast(table)).collect()]  # one row per class


def _edge_table(prefixes: DataFrame, quotas: DataFrame) -> DataFrame:
    running = W.partitionBy("_class").orderBy("_prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        prefixes.withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
        .join(quotas, "_class")
        .where("_before < _quota and _quota <= _before + _n")
        .select("_class", "_prefix", F.expr("_quota - _before").alias("_rest"), "_n")
    )


def _cuts(marked: DataFrame, group: str, edges: list[tuple]) -> list[tuple]:
    """Per class: the last chosen hash, how many rows with it are chosen, how many there are."""
    spark = marked.sparkSession
    class_field = T.StructField("_class", marked.schema[group].dataType)

    def near(edges: list[tuple], digits: int) -> DataFrame:
        """Rows whose hash starts with the deciding prefix of their class."""
        schema = T.StructType([class_field, T.StructField("_prefix", T.BinaryType()), T.StructField("_rest", T.LongType())])
        table = local_table(spark, [e[:3] for e in edges], schema)
        rows = marked.select(col(group).alias("_class"), _prefix(digits).alias("_prefix"), "_hash")
        return rows.join(F.broadcast(table), ["_class", "_prefix"])  # one row per class

    digits = PREFIX_DIGITS
    while digits < 16 and any(n > NEAR_ROWS for *_, n in edges):
        longer = near(edges, digits).select("_class", "_hash")
        digits += PREFIX_DIGITS
        edges = _edges(_count_prefixes(longer, "_class", digits), {c: rest for c, _, rest, _ in edges})
    return [tuple(r) for r in _cut_table(near(edges, digits)).collect()]


def _cut_table(near: DataFrame) -> DataFrame:
    # equal hashes collapse before the window
    hashes = near.groupBy("_class", "_hash").agg(F.count("*").alias("_same"), F.max("_rest").alias("_rest"))
    ordered = W.partitionBy("_class").orderBy("_hash").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        hashes.withColumn("_before", F.sum("_same").over(ordered) - F.col("_same"))
        .where("_before < _rest and _rest <= _before + _same")
        .select("_class", "_hash", F.expr("_rest - _before").alias("_need"), "_same")
    )
