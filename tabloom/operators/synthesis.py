"""Class-conditional synthesis: fit on a table of any size, sample any number of rows.

Every class has its own small adversarial model. The rows of a class are hashed
into shards of bounded size; in each round every shard trains on its own from
the shared weights, and the results are averaged per class, weighted by rows.
Rounds and optimizer steps follow from the class and the settings alone, whatever the number of shards. Nothing depends on row order,
partitioning or file layout: shards, shuffles and noise are seeded by content,
class and shard number.
"""

from __future__ import annotations

import bisect
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom import defaults as D
from tabloom.defaults import MAX_CLASSES
from tabloom.errors import ValidationError
from tabloom.functions.columns import col, is_infinite, to_double
from tabloom.functions.local import local_table
from tabloom.operators import adversarial as net
from tabloom.operators.checks import check_synthesis
from tabloom.operators.cleaning import fill_by_class
from tabloom.operators.journal import RoundJournal
from tabloom.operators.profiling import checked_counts
from tabloom.operators.sampling import pick_by_counts
from tabloom.operators.scaling import MinMaxScaler
from tabloom.scratch import materialize

# tasks get these functions themselves, so executors need no installed copy of the package
for _module in (net, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

SHARD_ROWS = 50_000
# and at most this many bytes, so that a shard of a wide table fits a Python worker
SHARD_BYTES = 64 * 1024 * 1024
# equal rows travel as one row with a number of copies, at most this many
COPIES = 256
BLOCK_ROWS = 4096
# blocks one sampling task makes at most, so that a lost one costs little
BLOCKS_PER_TASK = 512
ROUNDS = 10
# an epoch shows a model about as many rows of its shard, the whole class where it is smaller
EPOCH_ROWS = 50_000
# shards are written as this many files per core, or one each where there are fewer, with at most so many shards in each
FILES_PER_CORE, SHARDS_PER_FILE = 8, 64
# numbers in all model states together, held by the driver and sent to every executor
MAX_STATE = 50_000_000
ONE_CLASS = "_all"


@dataclass
class SynthModel:
    """What a fit learned; small, and savable as two Parquet tables."""

    columns: list[str]
    by: str | None
    class_type: str
    latent: int
    hidden: int
    scaler: MinMaxScaler
    counts: dict[Any, int]
    states: dict[Any, np.ndarray]
    steps: dict[Any, int]
    metrics: list[tuple] = field(default_factory=list)
    """(class, epoch, rows, shards, loss_g, loss_d)"""

    @property
    def layout(self) -> list[tuple[int, ...]]:
        return net.shapes(self.latent, self.hidden, len(self.columns))

    def metrics_table(self, spark: SparkSession) -> DataFrame:
        schema = f"class {self.class_type}, epoch int, rows bigint, shards int, loss_g double, loss_d double"
        return local_table(spark, self.metrics, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        data = [
            (
                k, self.columns, self.by, self.latent, self.hidden, n, self.steps[k],
                [float(self.scaler.limits[k][c][0]) for c in self.columns],
                [float(self.scaler.limits[k][c][1]) for c in self.columns],
                self.states[k].tolist(),
            )
            for k, n in self.counts.items()
        ]
        schema = (
            f"class {self.class_type}, columns array<string>, `by` string, latent int, hidden int, rows bigint, steps bigint, "
            "low array<double>, high array<double>, state array<double>"
        )
        local_table(spark, data, schema).write.mode("overwrite").parquet(f"{path}/models")
        self.metrics_table(spark).write.mode("overwrite").parquet(f"{path}/metrics")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SynthModel:
        models = spark.read.parquet(f"{path}/models")
        rows = sorted(models.collect(), key=lambda r: (r["class"] is not None, r["class"]))
        first = rows[0]
        limits = {r["class"]: dict(zip(r["columns"], zip(r["low"], r["high"]))) for r in rows}
        metrics = spark.read.parquet(f"{path}/metrics").orderBy("class", "epoch").collect()
        return SynthModel(
            first["columns"], first["by"], models.schema["class"].dataType.simpleString(), first["latent"], first["hidden"],
            MinMaxScaler(first["columns"], first["by"], limits),
            {r["class"]: r["rows"] for r in rows},
            {r["class"]: np.array(r["state"]) for r in rows},
            {r["class"]: r["steps"] for r in rows},
            [tuple(r) for r in metrics],
        )


def fit_summary(metrics: DataFrame) -> DataFrame:
    """Per class: epochs, final and smallest losses, ratio of the final ones."""
    return (
        metrics.groupBy("class")
        .agg(
            F.count("*").alias("total_epochs"),
            F.max_by("loss_g", "epoch").alias("final_generator_loss"),
            F.max_by("loss_d", "epoch").alias("final_discriminator_loss"),
            F.min("loss_g").alias("min_generator_loss"),
            F.min("loss_d").alias("min_discriminator_loss"),
        )
        .withColumn("convergence_ratio", F.col("final_discriminator_loss") / (F.col("final_generator_loss") + D.EPSILON))
    )


# --- fit -------------------------------------------------------------------


def fit(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    by: str | None = None,
    *,
    epochs: int = 1200,
    batch_size: int = D.BATCH_SIZE,
    latent_dim: int = D.LATENT_DIM,
    hidden: int = D.HIDDEN,
    learning_rate: float = D.LEARNING_RATE,
    seed: int = D.SEED,
    shard_rows: int = SHARD_ROWS,
    rounds: int | None = None,
    init_model: SynthModel | None = None,
    journal: str | None = None,
) -> SynthModel:
    """Fit one model per class of ``by`` (one in all without it) on numeric columns.

    ``rounds`` is how often shards are averaged. An epoch has as many optimizer steps as the class has
    batches, up to those of ``EPOCH_ROWS`` rows; every shard does as many. ``init_model`` continues an earlier fit.

    ``journal`` names a folder on shared storage that keeps the state after every round. The same fit of the same data, started again after its driver was lost, goes
    on behind the last round found there.
    """
    columns = list(columns or [c for c in df.columns if c != by])
    check_synthesis(epochs, batch_size, latent_dim, learning_rate, 1)
    if by is None:
        key, df = ONE_CLASS, df.select(*[col(c) for c in columns]).withColumn(ONE_CLASS, F.lit(0))
    else:
        key, df = by, df.select(*[col(c) for c in columns], col(by)).where(col(by).isNotNull())
    df, scaler, counts = _prepare(df, columns, key)

    if init_model is not None:
        latent_dim, hidden = init_model.latent, init_model.hidden
        if init_model.columns != columns:
            raise ValidationError("the given model was fitted on other columns")
    layout = net.shapes(latent_dim, hidden, len(columns))
    if len(counts) * 3 * net.weight_count(layout) > MAX_STATE:
        raise ValidationError(f"{len(counts)} models of {net.weight_count(layout)} weights are too large")
    states, steps = {}, {}
    for index, k in enumerate(counts):
        old = None if by is None else k
        if init_model is not None and old in init_model.states:
            states[k], steps[k] = init_model.states[old], init_model.steps[old]
        else:
            states[k], steps[k] = net.initial_state(layout, np.random.default_rng([seed, index])), 0

    spark = df.sparkSession
    shard_rows = max(batch_size, min(shard_rows, SHARD_BYTES // (4 * len(columns))))
    shards = pack_shards(scaler.transform(df), columns, key, counts, shard_rows)
    rounds = max(1, min(epochs, rounds or ROUNDS))
    batches = {k: max(1, min(n, EPOCH_ROWS) // min(batch_size, n)) for k, n in counts.items()}
    metrics, done, first = [], 0, 0
    if journal is not None:
        settings = dict(
            columns=columns, classes=[str(k) for k in counts], batches=list(batches.values()), steps=list(steps.values()), epochs=epochs, rounds=rounds,
            batch_size=batch_size, latent_dim=latent_dim, hidden=hidden, learning_rate=learning_rate, seed=seed, shard_rows=shard_rows,
        )
        log = RoundJournal(spark, journal, shards, settings, [states[k] for k in counts])
        first = min(rounds, log.rounds())
        if first:
            known, reached, told = log.read(first - 1)
            names = list(counts)
            states, steps = dict(zip(names, known, strict=True)), dict(zip(names, reached, strict=True))
            metrics = [(names[i], *m) for i, *m in told]
            done = sum(epochs // rounds + (r < epochs % rounds) for r in range(first))
    for r in range(first, rounds):
        local = epochs // rounds + (r < epochs % rounds)
        shared = spark.sparkContext.broadcast([(states[k], steps[k], batches[k]) for k in counts])
        partial = _train_round(shards, shared, layout, local, batch_size, learning_rate, [seed, r])
        new = [(k, done + e, n, s, g, d) for k, e, n, s, g, d in _average(partial, list(counts), states, steps, local)]
        metrics += new
        if journal is not None:
            number = {k: i for i, k in enumerate(counts)}
            log.write(r, [states[k] for k in counts], [int(steps[k]) for k in counts], [(number[k], *m) for k, *m in new])
        done += local
        shared.unpersist()

    if by is None:
        return SynthModel(
            columns, None, "int", latent_dim, hidden, MinMaxScaler(columns, None, {None: scaler.limits[0]}),
            {None: counts[0]}, {None: states[0]}, {None: steps[0]}, [(None, *m[1:]) for m in metrics],
        )
    class_type = df.schema[by].dataType.simpleString()
    return SynthModel(columns, by, class_type, latent_dim, hidden, scaler, counts, states, steps, metrics)


def _prepare(df: DataFrame, columns: Sequence[str], key: str) -> tuple[DataFrame, MinMaxScaler, dict]:
    """Filled table, limits and rows per class, from one pass and the medians that turn out to be needed.

    Medians lie between the finite limits of their class, so filling does not move them.
    """
    df = df.withColumns({c: to_double(col(c)) for c in columns})
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        v = col(c)
        finite = F.when(~is_infinite(v), v)
        aggs += [
            F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}"),
            F.count_if(v.isNull()).alias(f"null{i}"), F.count_if(is_infinite(v)).alias(f"inf{i}"),
        ]
    found = df.groupBy(col(key).alias("class")).agg(*aggs).limit(MAX_CLASSES + 1).collect()
    counts = checked_counts({r["class"]: r["rows"] for r in found}, key)
    if not counts:
        raise ValidationError("no rows to fit on")
    limits = {r["class"]: {c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(columns)} for r in found}
    empty = {c for lims in limits.values() for c, (low, _) in lims.items() if low is None}
    if empty:
        raise ValidationError(f"columns without values in some class: {sorted(empty)}")
    nulls = [c for i, c in enumerate(columns) if any(r[f"null{i}"] for r in found)]
    infinite = [c for i, c in enumerate(columns) if any(r[f"inf{i}"] for r in found)]
    if nulls or infinite:
        # filled once, not in every pass that follows
        df = materialize(fill_by_class(df, nulls, infinite, key, sum(counts.values())), "filled")
    return df, MinMaxScaler(list(columns), key, limits), counts


def pack_shards(scaled: DataFrame, columns: Sequence[str], key: str, counts: dict, shard_rows: int) -> DataFrame:
    """(i, shard, copies, data) with the class number ``i``: one row per shard, written once, read in every round.

    Rows go to shards by their content. Equal rows are counted first and travel in portions of copies, so a row with very
    many of them is spread like any other rows.
    """
    spark = scaled.sparkSession
    per_class = [math.ceil(n / shard_rows) for n in counts.values()]
    firsts = np.cumsum([0, *per_class]).tolist()
    # one row per class in both, at most MAX_CLASSES
    numbers = local_table(spark, list(zip(counts, range(len(counts)))), T.StructType([T.StructField("class", scaled.schema[key].dataType), T.StructField("i", T.LongType())]))
    sizes = local_table(spark, [(i, n, firsts[i]) for i, n in enumerate(per_class)], "i bigint, shards bigint, first bigint")
    named = scaled.select(col(key).alias("class"), *[col(c).cast("float").alias(f"x{i}") for i, c in enumerate(columns)])
    values = [f"x{i}" for i in range(len(columns))]
    counted = named.join(F.broadcast(numbers), "class").groupBy("i", *values).agg(F.count("*").alias("n"))
    portions = counted.withColumn("portion", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")))
    portions = portions.withColumn("copies", F.expr(f"cast(least({COPIES}, n - portion * {COPIES}) as int)"))
    placed = portions.withColumn("h", F.xxhash64(*values, "portion")).join(F.broadcast(sizes), "i")
    # the number of a shard among those of all classes
    placed = placed.select(F.expr("first + pmod(xxhash64(h), shards)").alias("place"), "h", "copies", *values)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        """The rows of one shard, in the order of their hashes."""
        rows = pa.Table.from_batches(held)
        order = np.argsort(rows["h"].to_numpy(), kind="stable")
        place = rows["place"][0].as_py()
        i = bisect.bisect_right(firsts, place) - 1
        data = np.stack([rows[c].to_numpy() for c in values], axis=1).astype(np.float32, copy=False)[order]
        lists = [[rows["copies"].to_numpy()[order].astype(np.int32)], [data.ravel()]]
        cells = [pa.array([i], pa.int64()), pa.array([place - firsts[i]], pa.int64()), pa.array(lists[0], pa.list_(pa.int32())), pa.array(lists[1], pa.list_(pa.float32()))]
        return pa.RecordBatch.from_arrays(cells, ["i", "shard", "copies", "data"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        place = None
        for batch in batches:
            places = batch.column("place").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(places)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and places[a] != place:
                    yield packed(held)
                    held = []
                place = places[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield packed(held)

    # training time goes with shards, not with bytes: equal rows make shards tiny, so their number says how they are dealt out
    files = min(firsts[-1], max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, math.ceil(firsts[-1] / SHARDS_PER_FILE)))
    # rows go straight to the file of their shard
    dealt = placed.repartitionById(files, F.pmod("place", F.lit(files)).cast("int")).sortWithinPartitions("place")
    return materialize(dealt.mapInArrow(pack, "i bigint, shard bigint, copies array<int>, data array<float>"), "shards")


def _train_round(shards, shared, layout, epochs, batch_size, learning_rate, seeds) -> DataFrame:
    """One row per class number and task: rows, shards, weighted state and loss sums."""
    width = layout[2][1]

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for batch in batches:
            for i, shard, copies, flat in zip(batch["i"], batch["shard"], batch["copies"], batch["data"]):
                state, before, batches = shared.value[i]
                data = np.repeat(np.asarray(flat, np.float32).reshape(-1, width), np.asarray(copies), axis=0)
                rng = np.random.default_rng([*seeds, int(i), int(shard)])
                state, after, losses = net.train_shard(
                    state, before, data, layout, epochs, batch_size, learning_rate, rng, batches
                )
                n = len(data)
                s = sums.setdefault(i, [0, 0, 0, np.zeros(len(state)), np.zeros((epochs, 2))])
                s[0] += n
                s[1] += 1
                s[2] = max(s[2], after)
                s[3] += n * state
                s[4] += n * losses
        for i, (n, count, after, state, losses) in sums.items():
            yield pd.DataFrame(
                {"i": [i], "rows": [n], "shards": [count], "steps": [after], "state": [state], "g": [losses[:, 0]], "d": [losses[:, 1]]}
            )

    schema = T.StructType(
        [
            shards.schema["i"],
            *[T.StructField(c, T.LongType()) for c in ("rows", "shards", "steps")],
            *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("state", "g", "d")],
        ]
    )
    return shards.mapInPandas(train, schema)


def _average(partial: DataFrame, classes: list, states: dict, steps: dict, epochs: int) -> list[tuple]:
    """Weighted means per class; updates ``states`` and ``steps``, returns losses per epoch."""
    # training is expensive, so its small result is written once, then whole vectors are added in two levels
    done = materialize(partial.withColumn("part", F.spark_partition_id()), "round")
    width = max(1, math.isqrt(done.agg(F.count_distinct("part")).first()[0]))
    columns = ["g", "d", "state"]

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part", kind="stable")
        total = {c: [np.sum(np.stack(rows[c].to_numpy()), axis=0)] for c in columns}
        numbers = {"rows": [rows["rows"].sum()], "shards": [rows["shards"].sum()], "steps": [rows["steps"].max()]}
        return pd.DataFrame({"i": [rows["i"].iloc[0]], "part": [rows["part"].iloc[0]], **numbers, **total})

    schema = "i bigint, part int, rows bigint, shards bigint, steps bigint, g array<double>, d array<double>, state array<double>"
    some = done.groupBy("i", (F.col("part") % width).alias("bucket")).applyInPandas(add, schema)
    sums = some.groupBy("i").applyInPandas(add, schema)
    losses = []
    for r in sorted(sums.collect(), key=lambda r: r["i"]):
        k, n = classes[r["i"]], r["rows"]
        states[k], steps[k] = np.array(r["state"]) / n, r["steps"]
        losses += [(k, e, n, r["shards"], r["g"][e] / n, r["d"][e] / n) for e in range(epochs)]
    return losses


# --- sample ----------------------------------------------------------------


def class_quotas(classes: Sequence[Any], n: int, strict_n: bool = False) -> dict[Any, int]:
    """Rows per class: equal shares of at least one, the rest to the first class.

    With fewer rows than classes every class still gets one row, unless
    ``strict_n`` asks for ``n`` rows in all.
    """
    each = max(1, n // len(classes))
    quotas = dict.fromkeys(classes, each)
    extra = n - each * len(classes)
    if extra > 0:
        quotas[classes[0]] += extra
    elif strict_n:
        quotas = {c: int(i < n) for i, c in enumerate(classes)}
    return quotas


def quota_table(spark: SparkSession, quotas: dict, class_type: str) -> DataFrame:
    return local_table(spark, list(quotas.items()), f"class {class_type}, rows bigint")


def sample_normalized(spark: SparkSession, model: SynthModel, quotas: dict[Any, int], seed: int = D.SEED) -> DataFrame:
    """Generator output in [-1, 1]; block ``b`` of a class is the same however it is partitioned."""
    classes = list(quotas)
    blocks = {k: math.ceil(n / BLOCK_ROWS) for k, n in quotas.items()}
    starts, total = {}, 0
    for k, b in blocks.items():
        starts[k] = total
        total += b
    size = net.weight_count(model.layout)
    layout, latent, names = model.layout, model.latent, model.columns
    shared = spark.sparkContext.broadcast(
        [(model.states[k][:size].astype(np.float32), starts[k], quotas[k]) for k in classes]
    )
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / BLOCKS_PER_TASK))
    plan = spark.range(0, total, 1, tasks).select("id", pick_by_counts(dict(enumerate(blocks.values())), F.col("id"), "int").alias("i"))

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, i in zip(batch.column("id").to_pylist(), batch.column("i").to_pylist()):
                flat, start, quota = shared.value[i]
                local = block - start
                n = min(BLOCK_ROWS, quota - local * BLOCK_ROWS)
                rng = np.random.default_rng([seed, i, local])
                noise = rng.standard_normal((n, latent), dtype=np.float32)
                made = net.generate(net.views(flat, layout), noise)[1].T.astype(np.float64, order="C")
                yield pa.RecordBatch.from_arrays([*map(pa.array, made), pa.array(np.full(n, i, np.int32))], [*names, "_i"])

    fields = [T.StructField(c, T.DoubleType()) for c in names]
    made = plan.mapInArrow(generate, T.StructType([*fields, T.StructField("_i", T.IntegerType())]))
    if model.by is None:
        return made.drop("_i")
    labels = F.array(*[F.lit(k).cast(model.class_type) for k in classes])
    return made.select(*[col(c) for c in names], F.element_at(labels, F.col("_i") + 1).alias(model.by))


def sample(spark: SparkSession, model: SynthModel, n: int, *, seed: int = D.SEED, strict_n: bool = False) -> DataFrame:
    """``n`` synthetic rows: the fitted columns, then the class. Values stay within the limits of their class."""
    quotas = {None: n} if model.by is None else class_quotas(list(model.counts), n, strict_n)
    return model.scaler.inverse(sample_normalized(spark, model, {k: q for k, q in quotas.items() if q > 0}, seed))


def synthesize(
    df: DataFrame, n: int, columns: Sequence[str] | None = None, by: str | None = None, *, strict_n: bool = False, **settings
) -> DataFrame:
    """Fit and sample in one call; ``settings`` as for :func:`fit`."""
    if n <= 0:
        raise ValidationError(f"n must be positive: {n}")
    model = fit(df, columns, by, **settings)
    return sample(df.sparkSession, model, n, seed=settings.get("seed", D.SEED), strict_n=strict_n)


def continue_fit(df: DataFrame, model: SynthModel, n: int | None = None, **settings) -> tuple[SynthModel, DataFrame]:
    """Train an existing model on and sample from it, by default as many rows as it was shown."""
    new = fit(df, model.columns, model.by, init_model=model, **settings)
    n = sum(new.counts.values()) if n is None else n
    return new, sample(df.sparkSession, new, n, seed=settings.get("seed", D.SEED))
