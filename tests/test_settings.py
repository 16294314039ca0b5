from pyspark.sql import functions as F

from lakemart.session import tune


def test_many_directories_are_listed_by_few_tasks(spark, tmp_path):
    tune(spark)
    for n in range(100):
        spark.range(1).write.parquet(f"{tmp_path}/{n}")
    spark.sparkContext.setJobGroup("listing", "")
    try:
        spark.read.schema("id long").parquet(*[f"{tmp_path}/{n}" for n in range(100)])
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        assert stages and max(s.numTasks for s in stages) <= 64
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_task_does_not_read_more_of_a_larger_table(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        tune(spark)
        rows = spark.range(1_500_000).select((F.col("id") * 7919).alias("k"))
        sizes = rows.repartition("k").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert sizes[1] == 1_500_000 and sizes[0] < 600_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
