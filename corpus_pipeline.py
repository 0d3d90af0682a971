"""Corpus pipeline: from raw documents to a deduplicated, decontaminated mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Null texts are
empty, other columns pass through, empty tables stay empty. Where an id is null or repeats, stages decide per row by its text.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.local import capped
from tabloom.llm import decontamination, line_dedup, mixing, near_dedup, quality
from tabloom.scratch import materialize


#: Rows that go to a Python task at once. Whole texts are long, and each task holds a batch on both sides.
BATCH_ROWS = 1000


def in_small_batches(stage):
    """A stage whose tables are made while it is called, with batches of ``BATCH_ROWS``, whoever calls it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with capped(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS):
            return stage(spark, docs, sf_dir)

    return run


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    stats = quality.with_statistics(docs.select("doc_id", "text")).select(F.col("row.doc_id").alias("id"), "stats")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    model = quality.fit_quality(stats, labels.where(~quality.held_out(F.col("id"))))
    return quality.with_statistics(docs).where(model.score(F.col("stats")) >= quality.KEEP_FROM).select("row.*")


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that is the id, or where there is none a number from the text behind all usual ids; and its name."""
    name = fresh("row_number", docs.columns)
    own = F.lit(1 << 62) + F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1))
    return docs.withColumn(name, F.coalesce(F.col("doc_id").cast("long"), own)), name


@in_small_batches
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that come earlier in the corpus, exactly or nearly; a document that loses all it had goes."""
    rows, number = numbered(docs)
    cut = line_dedup.drop_lines(rows, id_col=number)
    left = cut.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.col("n_dropped") > 0
    new = {
        "text": F.when(changed, F.col("text")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.length("text")).otherwise(F.col("row.n_chars") if "n_chars" in docs.columns else F.lit(None)),
    }
    return left.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@in_small_batches
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8), if there is one a row that has an id."""
    rows, number = numbered(docs)
    repeated = rows.groupBy(number).count().where("count > 1").limit(1).take(1)
    if repeated:  # rows that repeat id and text are one document
        rows = materialize(rows.dropDuplicates([number, "text"]), "near-rows")
        tag = fresh("text_tag", rows.columns)
        kept = near_dedup.near_dedup(rows, id_col=number, tag_col=tag).where("kept").select(number, tag).distinct()
        return rows.withColumn(tag, near_dedup.text_tag()).join(kept, [number, tag], "left_semi").select(*docs.columns)
    kept = near_dedup.near_dedup(rows, id_col=number).where("kept").select(number).distinct()
    return rows.join(kept, number, "left_semi").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256)
    leaks = decontamination.find_leaks(docs.select(key.alias("key"), "text"), benchmark, id_col="key")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    return rows.join(leaks.select("key").distinct(), "key", "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slot in a mixture of sources (weights: square root of their sizes)."""
    mixed = mixing.mix(docs, mixing.tempered_weights(docs))
    names = {c: fresh(f"mix_{c}", docs.columns) for c in ("block", "release", "deadline", "slot", "place")}
    return mixed.select("row.*", *[F.col(f"mixed.{c}").alias(name) for c, name in names.items()])


def fresh(name: str, taken) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Forward passes of a fitted classifier, MinHash links and components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with capped(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS):
        for k, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = materialize(docs, f"stage-{name}")
    return docs
