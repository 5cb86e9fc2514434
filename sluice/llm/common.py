"""Pieces that several corpus operators share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of our own only in local mode, where that is unset."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    have = sc._jsc.sc().getCheckpointDir()
    if have.isEmpty():
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="sluice-checkpoint-"))
        have = sc._jsc.sc().getCheckpointDir()
    return have.get()


def release() -> None:
    """Hand memory that a worker no longer uses back to the system, at the end of a task that used much.

    Workers live on for other stages' tasks, and Arrow's and C's allocators would keep it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_batches(spark: SparkSession, rows: int = 2048) -> None:
    """Let Arrow batches hold fewer rows, unless the session has a number of its own.

    Texts may be long: ten thousand to a batch, Spark's number, can be gigabytes in a worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


#: Whether a query's shuffle files go at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written tables in the shared folder: lineage ends there, and they are read more than once.

    Parquet there takes far less room than a checkpoint of rows, and can be removed:
    ``drop`` removes tables that no later step reads, ``close`` all. Results are
    computed later than the frames that describe them are made, so what a result
    still reads goes at the end of ``scope``, or when the driver ends.
    """

    scopes: list[list["Scratch"]] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = os.path.join(shared_dir(spark), f"scratch-{uuid.uuid4().hex}")
        atexit.register(self.close)
        if Scratch.scopes:
            Scratch.scopes[-1].append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table; the shuffles that made it go at once, not when the driver next collects garbage."""
        path, conf = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}", self.spark.conf
        before = conf.get(_CLEANUP, "false")
        conf.set(_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames: DataFrame | None) -> None:
        """Remove tables of this scratch; None stands for no table."""
        for df in frames:
            for folder in {os.path.dirname(f) for f in df.inputFiles()} if df is not None else ():
                _remove(self.spark, folder)

    def close(self) -> None:
        _remove(self.spark, self.root)
        atexit.unregister(self.close)

    @classmethod
    @contextlib.contextmanager
    def scope(cls) -> Iterator[None]:
        """At its end, every scratch made in it is removed; results must have been written elsewhere by then."""
        cls.scopes.append([])
        try:
            yield
        finally:
            for scratch in cls.scopes.pop():
                scratch.close()


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None and spark.sparkContext._jsc.sc().isStopped() is False:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Edges that one task handles in ``components``.
EDGES_A_TASK = 1 << 18


def components(edges: DataFrame, scratch: Scratch, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: (node, component), component the smallest node.

    Alternating large-star and small-star steps, each a groupBy-min and an
    equi-join, so a hub with a third of all links is pre-aggregated and its rows
    are split by AQE's skew join. Every step is written and the one before removed, in
    as many parts as its edges need; the loop ends when only stars are left. Only
    nodes that have an edge appear. Self loops and null ends are ignored; no edges
    give an empty frame.
    """
    u, v = F.col(src).cast("long"), F.col(dst).cast("long")
    e = scratch.write(edges.where(u.isNotNull() & v.isNotNull() & (u != v)).select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).distinct(), "edges")
    parts = -(-e.count() // EDGES_A_TASK)  # neither step makes more edges
    for _ in range(max_rounds if parts else 0):
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = scratch.write(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct().coalesce(parts), "large")
        scratch.drop(e)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = scratch.write(moved.union(low.select("a", F.col("m").alias("b"))).distinct().coalesce(parts), "small")
        scratch.drop(large)
        ends = e.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty():
            break  # each node is either the centre of a star or has one edge, to a centre
    else:
        if parts:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    star = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return star.union(star.select(F.col("component").alias("node"), "component").distinct())
