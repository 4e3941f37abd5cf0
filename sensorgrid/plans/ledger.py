"""A ledger of finished fits, so that a suite that was stopped goes on where it was.

An entry is a small file of its own under the ledger's folder (any Hadoop filesystem), written
after the task's model is saved: an entry means that score and model are whole, and concurrent
tasks never touch one another's entries. A task is known by the digest of what decides its result:
the data (:func:`frame_digest`), the model's name, target, horizon, settings or grid.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sensorgrid.operators import models as M
from sensorgrid.operators.common import q
from sensorgrid.sources.results import path_exists

SCHEMA = StructType([*M.SCORE_SCHEMA.fields, StructField("task", StringType()), StructField("model_path", StringType())])


def frame_digest(tf: M.TaskFrame) -> str:
    """Digest of a task frame's rows, in whatever order: one aggregation."""
    labels = [M.label_col(t, h) for t, h in tf.tasks]
    row = F.xxhash64(q(tf.key), "split", "__pos", vector_to_array("features"), *[q(c) for c in labels])
    r = tf.df.agg(F.count("*"), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr([tf.feature_names, tf.tasks, *map(str, r)]).encode()).hexdigest()


class Ledger:
    """Entries of ``folder`` that are there now; :meth:`once` adds to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.done = {r.task: r for r in self.entries().collect()} if path_exists(spark, self.folder) else {}

    def entries(self) -> DataFrame:
        """Score columns, task digest and model path of every finished task."""
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.folder)

    def of(self, tf: M.TaskFrame) -> "TaskLedger":
        return TaskLedger(self, frame_digest(tf))


class TaskLedger:
    """A ledger's tasks on one data set."""

    def __init__(self, ledger: Ledger, data: str):
        self.ledger, self.data = ledger, data

    def task(self, what: dict) -> str:
        return hashlib.sha256(json.dumps([self.data, what], sort_keys=True, default=str).encode()).hexdigest()

    def has(self, what: dict) -> bool:
        return self.task(what) in self.ledger.done

    def once(self, what: dict, work) -> tuple:
        """The score row of the task: from its entry, or of ``work()`` (row, model path), entered."""
        task, book = self.task(what), self.ledger
        if task in book.done:
            return tuple(book.done[task])[:len(M.SCORE_SCHEMA.fields)]
        row, path = work()
        book.spark.createDataFrame([(*row, task, path)], SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{book.folder}/{task}")
        return row
