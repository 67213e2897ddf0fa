"""Pieces shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firnline.session import configure, shared_folder

#: A word, for every rule that counts words: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

SETTINGS = {
    # Shuffle files of a finished query are of no use once its result is written.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Whole texts travel in batches; a batch stands several times in memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators (idempotent)."""
    configure(spark)
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives
    lost executors, and lets several readers use one computation."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the folders of tables made by :func:`written` that nothing reads again."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def worker_slot(key: Hashable, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps between its tasks: one object, made by ``build``
    when the key is not that of the object kept.  A worker serves the stages of many
    queries, so the next stage's object takes the last one's place.

    Functions reach tasks by value, so variables of their modules would start anew
    with each task.
    """
    slot = sys.modules.setdefault("_firnline_slot", types.ModuleType("_firnline_slot")).__dict__
    if slot.get("key") != key:
        slot.pop("kept", None)  # before the new one is built
        slot["kept"] = build()
        slot["key"] = key
    return slot["kept"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``df`` as a table sorted over the cluster, with each row's number from 0.

    A row's number is its place in its partition plus the rows of the partitions
    before; only one row per partition meets in one task.
    """
    rows = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted").withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    return rows.join(parts, "_part").select(*df.columns, (F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(name))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges ``(a, b)``: rows ``(node, label)``
    with the smallest node of the component as its label.

    Each round takes the smallest label among a node's neighbours and then
    follows labels of labels, so the rounds grow with the logarithm of the
    longest path.  Every round is written to the shared folder; only one count
    comes to the driver.
    """
    both = written(
        edges.select("a", "b").where("a <> b").union(edges.select(F.col("b"), F.col("a")).where("a <> b")).distinct(), "edges"
    )
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        )
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("_hop"))
        new = (
            labels.join(near, "node").join(hop, "label")
            .select("node", F.least("label", "_near", "_hop").alias("_new"), "label")
        )
        new = written(new, "labels")
        changed = new.where("_new <> label").limit(1).count()
        discard(labels)
        labels = new.select("node", F.col("_new").alias("label"))
        if not changed:
            discard(both)
            return labels
