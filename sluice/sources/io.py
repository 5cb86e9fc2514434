"""Reading and writing tables and texts, on any file system Spark reaches."""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer splits than there are cores is dealt out over all of them, where rows cost far more than their shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def numbered(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """A table read from files with its rows numbered from 0, in the order of the files' names and of the rows in them.

    No sort or shuffle: Spark's own ids grow within a split of a file; what is
    collected is one count per split, and a row's number is what stands before its
    split and its place in it.
    """
    marked = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__id"))
    splits = marked.groupBy("__file", "__start").agg(F.count("*").alias("n"), F.min("__id").alias("first")).collect()
    before, offsets = 0, []
    for r in sorted(splits, key=lambda r: (r["__file"], r["__start"])):
        offsets.append((r["__file"], r["__start"], before - r["first"]))
        before += r["n"]
    plus = df.sparkSession.createDataFrame(offsets, "__file string, __start long, __plus long")
    return marked.join(F.broadcast(plus), ["__file", "__start"]).withColumn(name, F.col("__id") + F.col("__plus")).select(name, *df.columns)


def load_raw(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """A CSV with a header as text throughout, rows numbered.

    Only an empty cell is null; blanks, NULL and N/A stay as they are. ``multi_line``
    lets cells hold line breaks, and makes each file one task; not given, that is so
    if any line of the files has an odd number of quotes.
    """
    if multi_line is None:
        line = F.col("value")
        multi_line = not spark.read.text(path).where((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1).isEmpty()
    raw = spark.read.options(header=True, inferSchema=False, multiLine=multi_line, escape='"', encoding="UTF-8", nullValue="", emptyValue="").csv(path)
    return numbered(raw).withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in raw.columns})


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the one that ``spark.checkpoint.dir`` names; in local mode, where that is unset, in one of our own. It goes when the driver ends."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = os.path.join(named or tempfile.mkdtemp(prefix="sluice-"), f"run-{uuid.uuid4().hex}")
    sc = spark.sparkContext
    atexit.register(lambda: sc._jsc is not None and not sc._jsc.sc().isStopped() and remove(spark, root))
    return root


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV with a header; a null is the empty cell, and no white space is trimmed. Written aside, then put in place."""
    spark, staging = df.sparkSession, path.rstrip("/") + ".staging"
    doubles = [c for c, t in df.dtypes if t == "double"]
    plain = df.withColumns({c: F.regexp_replace(F.format_string("%.2f", c), r"(\.\d)0$", "$1") for c in doubles}) if doubles else df
    plain.write.mode("overwrite").options(header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(staging)
    fs, target = _fs(spark, path)
    fs.delete(target, True)
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(staging), target)


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def fingerprint(spark: SparkSession, path: str) -> str:
    """First 16 hex digits of the SHA-256 of a file's bytes, read as a stream; of a folder, of its files' digests in order."""
    fs, p = _fs(spark, path)
    digest = spark._jvm.org.apache.commons.codec.digest.DigestUtils

    def one(at) -> str:
        stream = fs.open(at)
        try:
            return digest.sha256Hex(stream)
        finally:
            stream.close()

    if not fs.getFileStatus(p).isDirectory():
        return one(p)[:16]
    names = sorted(s.getPath().toString() for s in fs.listStatus(p) if not s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))
    return digest.sha256Hex("".join(one(spark._jvm.org.apache.hadoop.fs.Path(n)) for n in names))[:16]


def write_text(spark: SparkSession, path: str, content: str) -> str:
    """A text in UTF-8, its folders made."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content.encode("utf-8")))
    finally:
        out.close()
    return path


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_manifest(planted: DataFrame, path: str, about: dict) -> None:
    """Planted defects, one JSON record (defect, column, row_idx) a line, and what they were made from beside them."""
    planted.write.mode("overwrite").json(path)
    write_text(planted.sparkSession, os.path.join(path, "_about.json"), json.dumps(about))


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    return spark.read.schema("defect string, column string, row_idx long").json(path), json.loads(read_text(spark, os.path.join(path, "_about.json")))
