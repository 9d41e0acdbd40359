"""The next row of a table in the order of its id, without sorting the table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointgate.llm.text import materialise, partitions_for


def next_ids(ids: DataFrame) -> DataFrame:
    """doc_id and next_id for each distinct id: the next lower id, and for the lowest the highest.

    The ids are range-partitioned, numbered by partition and written once; within a partition the next id follows in
    the sort order, across partitions it is the highest id of the next partition that has any.  Only one row per
    partition meets in one task.
    """
    spark = ids.sparkSession
    parts = partitions_for(spark)
    placed = materialise(
        ids.select("doc_id").where("doc_id is not null").distinct()
        .repartitionByRange(parts, F.col("doc_id").desc())
        .withColumn("__part", F.spark_partition_id()),
        "ranges",
    )
    edges = placed.groupBy("__part").agg(F.max("doc_id").alias("__top"))
    whole = Window.orderBy(F.col("__part"))  # as many rows as partitions
    following = F.coalesce(F.lead("__top").over(whole), F.max("__top").over(Window.partitionBy()))
    edges = edges.select(F.col("__part"), following.alias("__following"))
    inside = Window.partitionBy("__part").orderBy(F.col("doc_id").desc())
    return (
        placed.withColumn("__lead", F.lead("doc_id").over(inside))
        .join(F.broadcast(edges), "__part")
        .select("doc_id", F.coalesce("__lead", "__following").alias("next_id"))
    )
