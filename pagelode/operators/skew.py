"""Joins that a hot key cannot stall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.operators.lineage import cut


def salted_join(many: DataFrame, few: DataFrame, key: str, spread: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """many join few where one key may hold a large part of many and few has about one row a key.

    Rows of many go to one of salts parts by the hash of spread; few is repeated once per part. how: inner, left, left_semi, left_anti.
    """
    many = many.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    few = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.join(few, [key, "__salt"], how).drop("__salt")


def spread_join(a: DataFrame, b: DataFrame, key: str, by: str, most: int) -> DataFrame:
    """a join b on key where both may hold a key many times, and every pair is wanted. b is read twice: cut it first.

    A key that more than most rows of b have is dealt to parts of about most rows by the hash of b's column by; a's rows of the key are repeated once per part.
    """
    hot = b.groupBy(key).count().filter(F.col("count") > most).select(key, F.ceil(F.col("count") / most).cast("int").alias("__parts"))
    hot = cut(hot)
    if hot.isEmpty():
        return a.join(b, key)
    hot = bounded_broadcast(hot, 10_000)
    parts = F.coalesce("__parts", F.lit(1))
    many = b.join(hot, key, "left").withColumn("__part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("__parts")
    few = a.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return few.join(many, [key, "__part"]).drop("__part")


BY_PLACE = "spark.sql.requireAllClusterKeysForCoPartition"  # false while what comes of meeting_join is run, else the planner deals its rows anew by key too


def meeting_join(a: DataFrame, b: DataFrame, place: str, key: str, by: str, most: int) -> DataFrame:
    """a join b on place and key, all pairs of one row of a and one value of b's column by at a place in one task. b is read twice: cut it first.

    What is summed up by place, __part and both rows then needs no shuffle, so the pairs that meet never lie on a disk. A place that more than
    most rows of b have is dealt to parts of about most rows by the hash of by; a's rows of the place are repeated once per part."""
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = b.groupBy(place).count().filter(F.col("count") > most).select(place, F.ceil(F.col("count") / most).cast("int").alias("__parts"))
    hot = bounded_broadcast(cut(hot), 10_000)
    parts = F.coalesce("__parts", F.lit(1))
    many = b.join(hot, place, "left").withColumn("__part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("__parts")
    few = a.join(hot, place, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return few.repartition(tasks, place, "__part").join(many.repartition(tasks, place, "__part"), [place, "__part", key])


def spread_left_join(a: DataFrame, b: DataFrame, key: str, by: str, most: int) -> DataFrame:
    """a left join b on key where both may hold a key many times. b is read twice: cut it first.

    A key that more than most rows of b have is dealt to parts by the hash of b's column by, a's rows of the key are repeated once per part. The
    rows that come of a key are many more than those that go in, so the tasks are as many as spark.sql.shuffle.partitions says and are not
    merged by the size of their input; four parts a task are enough to fill them all."""
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = b.groupBy(key).count().filter(F.col("count") > most).select(key, F.least(F.ceil(F.col("count") / most), F.lit(4 * tasks)).cast("int").alias("__parts"))
    hot = cut(hot)
    if hot.isEmpty():
        return a.join(b, key, "left")
    hot = bounded_broadcast(hot, 10_000)
    parts = F.coalesce("__parts", F.lit(1))
    many = b.join(hot, key, "left").withColumns({"__part": F.pmod(F.xxhash64(by), parts).cast("int"), "__met": F.lit(True)}).drop("__parts")
    few = a.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    few = few.withColumn("__part", F.when(F.col(key).isNotNull(), F.col("__part")).otherwise(F.spark_partition_id()))  # a null key meets none, wherever it lies
    rows = few.repartition(tasks, key, "__part").join(many.repartition(tasks, key, "__part"), [key, "__part"], "left")
    return rows.filter("__met or __parts is null").drop("__part", "__parts", "__met")  # a hot key has rows of b, though perhaps not in every part


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast if it has no more than so many rows; unmarked otherwise, for a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
