"""What a fit has reached, round by round, on shared storage."""

from __future__ import annotations

import hashlib
import json
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.columns import hash_total
from tabloom.functions.local import local_table
from tabloom.scratch import is_complete

STATES = "i int, steps bigint, state array<double>"
METRICS = "i int, epoch int, rows bigint, shards int, loss_g double, loss_d double"


class RoundJournal:
    """States and metrics after each round, under a key made of the data's content and all settings.

    A fit with the same key goes on behind the last round that was written to its end; another key starts a journal of its own in the same folder.
    A round is two tables, the states last, so one that was cut short isn't found.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: DataFrame, settings: dict[str, Any], states: list[np.ndarray]):
        n, total = hash_total(shards, F.xxhash64("i", "shard", "copies", "data"))
        first = hashlib.sha256(b"".join(np.ascontiguousarray(x, np.float64).tobytes() for x in states)).hexdigest()
        told = json.dumps([n, str(total), first, settings], sort_keys=True, default=str)
        self.spark, self.path = spark, f"{folder.rstrip('/')}/{hashlib.sha256(told.encode()).hexdigest()[:32]}"

    def _place(self, number: int) -> str:
        return f"{self.path}/round-{number:05}"

    def write(self, number: int, states: list[np.ndarray], steps: list[int], metrics: list[tuple]) -> None:
        local_table(self.spark, metrics, METRICS).coalesce(1).write.mode("overwrite").parquet(f"{self._place(number)}/metrics")
        rows = [(i, steps[i], state.tolist()) for i, state in enumerate(states)]
        local_table(self.spark, rows, STATES).coalesce(1).write.mode("overwrite").parquet(f"{self._place(number)}/states")

    def rounds(self) -> int:
        """Rounds that were written to their end, without a gap."""
        n = 0
        while is_complete(self.spark, f"{self._place(n)}/states") and is_complete(self.spark, f"{self._place(n)}/metrics"):
            n += 1
        return n

    def read(self, number: int) -> tuple[list[np.ndarray], list[int], list[tuple]]:
        """States and steps after a round, and the metrics of all rounds up to it."""
        rows = self.spark.read.schema(STATES).parquet(f"{self._place(number)}/states").orderBy("i").collect()
        metrics = []
        for k in range(number + 1):
            metrics += [tuple(r) for r in self.spark.read.schema(METRICS).parquet(f"{self._place(k)}/metrics").orderBy("i", "epoch").collect()]
        return [np.array(r["state"]) for r in rows], [r["steps"] for r in rows], metrics
