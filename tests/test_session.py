from pyspark.sql import functions as F

from scriptorium.session import CLEANUP_KEY, through_table


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllBlocks().mkString(",").split(",") if name.startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    as_set = spark.conf.get(CLEANUP_KEY)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    stored = through_table(counted, "counted", drop_shuffles=True)
    assert sorted(tuple(r) for r in stored.collect()) == sorted(tuple(r) for r in counted.collect())
    assert through_table(counted.repartition(3, "n"), "again", drop_shuffles=True).count() == 7
    counted = spark.range(500).repartition(5, "id").distinct()
    held = shuffle_files(spark)
    through_table(counted, "distinct", drop_shuffles=True)
    assert shuffle_files(spark) <= held
    assert spark.conf.get(CLEANUP_KEY) == as_set
