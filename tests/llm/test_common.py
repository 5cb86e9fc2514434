import os

from pyspark.sql import functions as F

from sluice.llm.common import Scratch


def shuffle_files(spark):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {x for top in folders for _, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    """They would stay until the driver next collects garbage, and add up to more disk than a step takes."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_to = shuffle_files(spark), spark.conf.get(setting)
    scratch = Scratch(spark)
    table = scratch.write(spark.range(1000).withColumn("k", F.col("id") % 7).repartition(3, "k").groupBy("id").count(), "t")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(setting) == set_to
    assert table.count() == 1000
    scratch.close()
