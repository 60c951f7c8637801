"""Cutting lineage, and numbering rows, without one task or executor that must hold everything."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one where none is set on a single machine, an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="pagemart-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def plain_unions(spark: SparkSession) -> None:
    """Turns off what Spark 4.1 says of unions: of parts that are dealt alike, that the whole is dealt so too.

    Adaptive execution may put the parts one after the other all the same, and a window, join or grouping
    that trusts it then works on each part by itself.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over all of spark.sql.shuffle.partitions, for joins and groupings of many small rows.

    Adaptive execution puts parts together by their compressed bytes, and rows of keys that follow each other
    shrink so far that a few tasks would sort them all; parts dealt by number stay as many as they are.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df, written to a table in the shared folder and read back.

    For loops that join what they cut with itself: a checkpoint keeps the estimated size of its
    plan, which a join squares, so that after twenty rounds the estimate has millions of digits;
    a table has the size of its files. The table stays there until dropped().
    """
    folder = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def dropped(*tables: DataFrame) -> None:
    """Deletes what written() wrote, where nothing reads it any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def numbered(df: DataFrame, *order: Column | str, out: str = "rn") -> DataFrame:
    """df with out = 1, 2, ... in order.

    Rows are dealt into ranges, numbered within each, and shifted by the sizes of
    the ranges before; only those sizes meet in one task.
    """
    ranges = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranges.withColumn(out, within).join(before, "_range").withColumn(out, F.col(out) + F.col("_before")).drop("_range", "_before")


def numbered_within(df: DataFrame, group: str, *order: Column | str, out: str = "rn") -> DataFrame:
    """df with out = 1, 2, ... in order within each group, however many of the rows one group has.

    Rows are dealt into ranges of (group, order); a group's rows in a range are
    numbered there and shifted by how many it has in the ranges before.
    """
    ranges = cut(df.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_group", "_of", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    rows = ranges.withColumn(out, F.row_number().over(Window.partitionBy("_range", group).orderBy(*order)))
    joined = rows.join(before, (F.col("_range") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(out, F.col(out) + F.col("_before")).drop("_range", "_of", "_group", "_before")


def with_previous(df: DataFrame, group: str, value: Column, out: str = "previous") -> DataFrame:
    """df with the next smaller or equal value of the row's group, by ranges as above; null for the first."""
    ranges = cut(df.withColumn("_value", value).repartitionByRange(group, "_value").withColumn("_range", F.spark_partition_id()))
    last = ranges.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(F.max("_value").alias("_last"))
    ahead = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("_group", "_of", F.max("_last").over(ahead).alias("_before"))
    rows = ranges.withColumn(out, F.lag("_value").over(Window.partitionBy("_range", group).orderBy("_value")))
    joined = rows.join(last, (F.col("_range") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(out, F.coalesce(out, "_before")).drop("_range", "_of", "_group", "_before", "_value")
