"""A corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's docs. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontam, lines, packing, simhash, toxicity
from sluice.llm.common import Scratch
from sluice.llm.queries import table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the machine learns from those of docs that ``labels`` covers."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine, name="__score").where("__score < 0.7").drop("__score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; ``n_chars`` follows, where docs has it. All rows stay."""
    out = lines.dedup_lines(docs).drop("n_removed")
    return out.withColumn("n_chars", F.length("text").cast(dict(out.dtypes)["n_chars"])) if "n_chars" in out.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest (id, hash of its words), null ids last.

    Near duplicates have a similarity of 0.8 or more of their five-word shingles, by
    wide SimHash fingerprints. Ids play no part in what a group is: rows that share an
    id, or have none, go only where their texts are similar.
    """
    found = simhash.similar(docs)
    row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "t"))
    first = found.groupBy("component").agg(row.alias("r")).select(F.col("r.doc_id").alias("__id"), F.col("r.t").alias("__first"))
    given = docs.withColumn("__t", F.xxhash64("text"))
    kept = given.join(first, (F.col("__t") == F.col("__first")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__t"]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; see ``sluice.llm.packing``."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), payload="crc32", keep_words=False)


STAGES = [("toxicity", toxic), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("packing", pack)]

#: Fingerprints, models and token ids are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; a stage's intermediates go once its result is written, the result once the next one's is."""
    docs, before, scratch = table(spark, sf_dir, "documents"), None, Scratch(spark)
    for name, stage in STAGES:
        with Scratch.scope():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
        before = docs
    return docs
