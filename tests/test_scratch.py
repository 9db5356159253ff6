"""Stored tables: their rows, and what writing them leaves behind."""

from pyspark.sql import functions as F

from idweave.sources.scratch import _FREE, store


def test_store_leaves_no_shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = lambda: {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before, setting = files(), spark.conf.get(_FREE, None)
    counts = spark.range(100_000).withColumn("k", F.col("id") % 1009).groupBy("k").agg(F.count("*").alias("n"))
    kept = store(counts, "counts")
    assert not files() - before and spark.conf.get(_FREE, None) == setting
    assert kept.agg(F.sum("n")).first()[0] == 100_000 and kept.count() == 1009
    assert counts.count() == counts.count() == 1009  # the frame itself may be run again
