"""Connected components, and tables written to cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors see. Where it is unset, a temporary one if Spark runs in one process, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="safra-")
    return _own[context.applicationId]


def cut(df: DataFrame) -> DataFrame:
    """Write to the folder in ``spark.checkpoint.dir`` and read back: a short lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held.written_at = path
    return held


def drop(*frames: DataFrame) -> None:
    """Delete what ``cut`` has written for them, once nothing reads it any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node of each component, to whatever depth it reaches.

    ``vertices`` has ``node``, ``edges`` has ``a, b``. Labels spread to neighbours and
    then through the labels' own labels, so chains shorten by more than one a round, until no label changes.
    """
    links = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    links = cut(links)
    labels = cut(vertices.select("node", F.col("node").alias("component"), F.col("node").alias("was")))
    while True:
        near = links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("low"))
        step = labels.join(near, labels["node"] == near["a"], "left").select("node", F.least("component", F.coalesce("low", "component")).alias("component"), F.col("component").alias("was"))
        jump = step.select(F.col("node").alias("at"), F.col("component").alias("onward"))
        moved = cut(step.join(jump, step["component"] == jump["at"]).select("node", F.least("component", "onward").alias("component"), "was"))
        drop(labels)
        labels = moved
        if not moved.where("component != was").limit(1).count():
            break
    drop(links)
    return labels.select("node", "component")
