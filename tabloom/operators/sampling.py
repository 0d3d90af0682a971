"""Stratified split, undersampling, bootstrap of labels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.defaults import BALANCED_RATIO, SEED, TEST_SIZE
from tabloom.errors import ValidationError
from tabloom.functions.columns import col, hash_uniform, present
from tabloom.functions.local import local_table
from tabloom.operators.checks import BALANCING_METHODS, check_split
from tabloom.operators.profiling import checked_counts
from tabloom.operators.ranks import totals_before
from tabloom.operators.selection import take_per_group
from tabloom.scratch import materialize

# classes that one expression may list
FEW_CLASSES = 64
# draws of a bootstrap that one range of places gets, about
RANGE_DRAWS = 100_000


def target_last(df: DataFrame, target: str) -> DataFrame:
    return df.select(*[col(c) for c in df.columns if c != target], col(target))


# --- split -----------------------------------------------------------------


def split_quotas(counts: dict, test_size: float = TEST_SIZE) -> dict:
    """Test rows per class.

    The training side gets the floor of its proportional share per class, the
    rest by largest fraction (first class on ties); the test side the remainder.
    """
    total = sum(counts.values())
    test = math.ceil(Fraction(str(test_size)) * total)
    train = total - test
    small = [c for c, n in counts.items() if n < 2]
    if small:
        raise ValidationError(f"classes with fewer than 2 rows cannot be split: {small}")
    if min(train, test) < len(counts):
        raise ValidationError(f"{train} + {test} rows are too few for {len(counts)} classes")
    shares = {c: Fraction(n * train, total) for c, n in counts.items()}
    quota = {c: math.floor(s) for c, s in shares.items()}
    left = train - sum(quota.values())
    by_fraction = sorted(shares, key=lambda c: quota[c] - shares[c])
    for c in by_fraction[:left]:
        quota[c] += 1
    return {c: n - quota[c] for c, n in counts.items()}


def split_quota_table(counts: DataFrame, test_size: float = TEST_SIZE) -> DataFrame:
    """(_class, _quota) of :func:`split_quotas` for any number of classes, from (_class, n).

    Only the sums reach the driver. The classes with the largest fractions are found by numbering all of them
    in order of fraction over range partitions.
    """
    seen = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"), F.min("n").alias("least")).first()
    total, test = seen.total, math.ceil(Fraction(str(test_size)) * seen.total)
    train = total - test
    if seen.least < 2:
        small = [r[0] for r in counts.where("n < 2").select("_class").limit(10).collect()]
        raise ValidationError(f"classes with fewer than 2 rows cannot be split: {small} and maybe others")
    if min(train, test) < seen.k:
        raise ValidationError(f"{train} + {test} rows are too few for {seen.k} classes")
    # whole numbers of up to 38 digits: n * train, its quotient by the total and the remainder, which stands for the fraction
    shares = counts.selectExpr("_class", "n", f"cast(n as decimal(19, 0)) * cast({train} as decimal(18, 0)) as s")
    shares = shares.selectExpr("_class", "n", f"cast(s div {total} as long) as base", f"cast(s % {total} as long) as rest")
    shares = materialize(shares, "split-shares")
    left = train - shares.agg(F.sum("base")).first()[0]
    order = F.struct((-F.col("rest")).alias("rest"), "_class").alias("order")
    numbered, _ = totals_before(shares.select(order, F.lit(1).alias("one"), "n", "base"), "order", ["one"])
    kept = F.col("base") + F.when(F.col("one_before") < left, 1).otherwise(0)
    return numbered.select("order._class", (F.col("n") - kept).alias("_quota"))


@dataclass
class Split:
    """``counts`` and ``test_counts`` by class: dictionaries, or tables (_class, n) and (_class, _quota) beyond ``DRIVER_CLASSES`` classes."""

    train: DataFrame
    test: DataFrame
    counts: dict | DataFrame
    test_counts: dict | DataFrame
    hashed_train: DataFrame | None = None
    """the train rows with their hashes, where the split was given some: what :func:`undersample` takes for the same keys and seed"""


def stratified_split(
    df: DataFrame,
    target: str,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    keys: Sequence[str] | None = None,
    hashed: bool = False,
) -> Split:
    """Exact proportional split into train and test; the target becomes the last column.

    ``hashed`` says that ``df`` comes from :func:`with_hashes` with these keys and this seed.
    """
    check_split(test_size, seed)
    chosen = take_per_group(
        df, target, lambda n: split_quotas(n, test_size), keys, seed, table_quotas=lambda n: split_quota_table(n, test_size), hashed=hashed
    )
    return Split(
        target_last(chosen.others(), target), target_last(chosen.chosen(), target), chosen.counts, chosen.quotas,
        chosen.others_with_hashes() if hashed and keys else None,
    )


# --- balance ---------------------------------------------------------------


@dataclass
class Balanced:
    """Counts by class are dictionaries, or tables (_class, n) and (_class, _quota) beyond ``DRIVER_CLASSES`` classes."""

    table: DataFrame
    counts_before: dict | DataFrame
    counts_after: dict | DataFrame
    method: str = BALANCING_METHODS[0]

    def report(self) -> dict:
        """With more classes than fit a report, their number and the rows of each stand for the distribution."""
        if isinstance(self.counts_before, DataFrame):
            seen = self.counts_before.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"), F.min("n").alias("least")).first()
            return {
                "method": self.method,
                "new_distribution": {"classes": seen.classes, "rows_of_each": seen.least},
                "samples_removed": seen.rows - seen.classes * seen.least,
                "original_samples": seen.rows,
                "balanced_samples": seen.classes * seen.least,
            }
        before, after = sum(self.counts_before.values()), sum(self.counts_after.values())
        return {
            "method": self.method,
            "new_distribution": self.counts_after,
            "samples_removed": before - after,
            "original_samples": before,
            "balanced_samples": after,
        }

    def report_table(self) -> DataFrame:
        """One row per class: rows before, after and removed."""
        if isinstance(self.counts_before, DataFrame):
            both = self.counts_before.join(self.counts_after, "_class")
            return both.selectExpr("_class as class", "n as before", "_quota as after", "n - _quota as removed")
        data = [(c, n, self.counts_after[c], n - self.counts_after[c]) for c, n in self.counts_before.items()]
        class_type = self.table.schema.fields[-1].dataType.simpleString()
        return local_table(
            self.table.sparkSession,
            data, f"class {class_type}, before bigint, after bigint, removed bigint"
        )


def undersample(
    df: DataFrame,
    target: str,
    method: str = BALANCING_METHODS[0],
    seed: int = SEED,
    keys: Sequence[str] | None = None,
    hashed: bool = False,
) -> Balanced:
    """Every class down to the size of the smallest, without replacement; target last.

    ``hashed`` says that ``df`` comes with the hashes of these keys and this seed, as :func:`with_hashes` makes them.
    """
    if method not in BALANCING_METHODS:
        raise ValidationError(f"unsupported balancing method: {method}")
    chosen = take_per_group(
        df, target, lambda n: dict.fromkeys(n, min(n.values())) if n else {}, keys, seed,
        table_quotas=lambda n: n.select("_class", F.lit(n.agg(F.min("n")).first()[0]).alias("_quota")), hashed=hashed,
    )
    return Balanced(target_last(chosen.chosen(), target), chosen.counts, chosen.quotas, method)


def balance_validation(before: DataFrame, after: DataFrame, target: str) -> DataFrame:
    """Max/min class ratios of two tables, their quotient, and whether the second is balanced."""

    def ratio(df: DataFrame, name: str) -> DataFrame:
        sizes = df.where(col(target).isNotNull()).groupBy(col(target)).agg(F.count("*").alias("n"))
        return sizes.agg(F.try_divide(F.max("n"), F.min("n")).alias(name))

    both = ratio(before, "r").select(F.lit("before").alias("t"), "r").unionAll(
        ratio(after, "r").select(F.lit("after").alias("t"), "r")
    )
    one = both.agg(
        F.max(F.expr("if(t = 'before', r, null)")).alias("original_imbalance_ratio"),
        F.max(F.expr("if(t = 'after', r, null)")).alias("balanced_imbalance_ratio"),
    )
    return one.withColumn(
        "improvement_factor", F.try_divide("original_imbalance_ratio", "balanced_imbalance_ratio")
    ).withColumn("is_balanced", F.col("balanced_imbalance_ratio") <= BALANCED_RATIO)


def validation_report(before: dict, after: dict) -> dict:
    """The same from class counts already at hand."""
    b, a = max(before.values()) / min(before.values()), max(after.values()) / min(after.values())
    return {
        "original_imbalance_ratio": b,
        "balanced_imbalance_ratio": a,
        "improvement_factor": b / a,
        "is_balanced": a <= BALANCED_RATIO,
    }


# --- bootstrap -------------------------------------------------------------


def pick_by_counts(counts: dict, rank: Column, class_type: str) -> Column:
    """The class holding place ``rank`` when classes are laid out one after the other."""
    ends, total = [], 0
    for n in counts.values():
        total += n
        ends.append(total)
    if 0 < len(counts) <= FEW_CLASSES:  # compiled, as a search of an array is not
        held = [F.lit(c).cast(class_type) for c in counts]
        places = F.when(rank < F.lit(ends[0]).cast("bigint"), held[0])
        for e, c in zip(ends[1:], held[1:]):
            places = places.when(rank < F.lit(e).cast("bigint"), c)
        return places
    places = F.array(*[F.lit(e).cast("bigint") for e in ends])
    classes = F.array(*[F.lit(c).cast(class_type) for c in counts])
    return F.element_at(classes, (F.size(F.filter(places, lambda e: e <= rank)) + 1).cast("int"))


def bootstrap_from_counts(spark: SparkSession, counts: dict, n: int, target: str, class_type: str, seed: int = SEED) -> DataFrame:
    """``n`` labels drawn with replacement; the i-th depends on seed and i only."""
    total = sum(counts.values())
    rank = F.floor(hash_uniform(seed, F.col("id")) * F.lit(float(total))).cast("bigint")
    drawn = spark.range(n).select("id", rank.alias("rank"))
    return drawn.select("id", pick_by_counts(counts, F.col("rank"), class_type).alias(target))


def bootstrap_by_table(spark: SparkSession, counts: DataFrame, n: int, target: str, seed: int = SEED) -> DataFrame:
    """The same from a table (class, rows) of any size: each drawn place meets the class that holds it inside its range of places."""
    ends, totals = totals_before(counts, "class", ["rows"])
    ends = materialize(ends, "bootstrap-classes")
    total = totals["rows"]
    width = max(1, total * RANGE_DRAWS // max(n, total, 1))  # so many places to a range, and about as many draws
    # a class is known in every range that it reaches into, from where it begins there
    span = ends.withColumn("range", F.explode(F.expr(f"sequence(rows_before div {width}, (rows_before + rows - 1) div {width})")))
    begins = span.select("range", F.greatest("rows_before", F.col("range") * width).alias("place"), F.lit(None).cast("long").alias("id"), F.col("class"))
    place = F.floor(hash_uniform(seed, F.col("id")) * F.lit(float(total))).cast("bigint")
    drawn = spark.range(n).select("id", place.alias("place")).select(
        F.expr(f"place div {width}").alias("range"), "place", "id", F.lit(None).cast(counts.schema["class"].dataType).alias("class")
    )
    order = W.partitionBy("range").orderBy(F.col("place"), F.col("id").asc_nulls_first())
    held = F.last("class", ignorenulls=True).over(order)
    return begins.unionByName(drawn).select("id", held.alias(target)).where("id is not null")


def bootstrap_labels(df: DataFrame, target: str, n: int, seed: int = SEED) -> DataFrame:
    """Labels drawn with replacement from the target column of ``df``: (id, target).

    A few classes are laid out in the expression itself; more are met by ranges of places.
    """
    counts = df.groupBy(present(df, target).alias("class")).agg(F.count("*").alias("rows"))
    few = counts.limit(FEW_CLASSES + 1).collect()
    if len(few) > FEW_CLASSES:
        counts = materialize(counts, "bootstrap-counts")
        nulls = counts.where("class is null").first()
        if nulls:
            raise ValidationError(f"{target} has {nulls['rows']} rows without a class")
        return bootstrap_by_table(df.sparkSession, counts, n, target, seed)
    found = checked_counts({r["class"]: r["rows"] for r in few}, target)
    return bootstrap_from_counts(df.sparkSession, found, n, target, df.schema[target].dataType.simpleString(), seed)
