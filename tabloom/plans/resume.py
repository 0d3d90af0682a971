"""Which stages of a run are whole, so that the same run does only what is left."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.columns import col, hash_total
from tabloom.scratch import is_complete
from tabloom.sources import write_report
from tabloom.sources.writers import plain

#: Goes into every key; a change of what a stage writes changes it.
LAYOUT = 1


def _digest(*parts: Any) -> str:
    return hashlib.sha256(json.dumps(plain(parts), sort_keys=True, default=str).encode()).hexdigest()


def source_key(spark: SparkSession, source: str | DataFrame, fmt: str | None = None) -> str:
    """Names, sizes and times of the files at a path, whose content is not read; or the content of a table, in any order of rows."""
    if isinstance(source, DataFrame):
        cells = [col(f.name).cast("string") if isinstance(f.dataType, (T.MapType, T.VariantType)) else col(f.name) for f in source.schema.fields]
        rows, told = source.select(F.xxhash64(*cells, F.lit(LAYOUT)).alias("h")), source.schema.simpleString()
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
        rows, told = files.select(F.xxhash64("path", "length", "modificationTime").alias("h")), [source, fmt]
    n, total = hash_total(rows, F.col("h"))
    return _digest(LAYOUT, told, n, str(total))


class StageLog:
    """Manifests of the stages in ``out_dir``, each written after all that its stage writes.

    A manifest holds a key made of the source, the settings of its stage and those of all stages before it, and the stage's report. A
    stage whose key fits and whose tables were written to their end is read back, others are done. A manifest is emptied
    before its stage writes anything, so tables that another run left half or whole are never taken for this one's.
    Without ``out_dir`` every stage is done.
    """

    def __init__(self, spark: SparkSession, out_dir: str | None, key: str = ""):
        self.spark, self.out_dir, self.key = spark, out_dir, key
        self.reused: list[str] = []

    def stage(
        self, name: str, settings: dict[str, Any], tables: Sequence[str], make: Callable[[], tuple[list[DataFrame], dict[str, Any]]]
    ) -> tuple[list[DataFrame], dict[str, Any]]:
        """Tables (by their places in ``out_dir``) and report of a stage; a report that is read back is plain JSON, its keys are strings."""
        if self.out_dir is None:
            return make()
        self.key = _digest(self.key, name, settings)
        place, paths = f"{self.out_dir}/manifests/{name}", [f"{self.out_dir}/{t}" for t in tables]
        told = self._read(place)
        if told["key"] == self.key and all(is_complete(self.spark, p) for p in paths):
            self.reused.append(name)
            return [self.spark.read.parquet(p) for p in paths], told["report"]
        write_report(self.spark, {"key": None}, place)
        made, report = make()
        write_report(self.spark, {"key": self.key, "report": report}, place)
        return made, report

    def _read(self, place: str) -> dict[str, Any]:
        if not is_complete(self.spark, place):
            return {"key": None}
        return json.loads(self.spark.read.text(place, wholetext=True).first()[0])
