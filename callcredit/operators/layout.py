"""A fact table laid out once by key, for several joins without a shuffle.

``lay_out`` writes rows bucketed by (key, salt). Keys that hold more rows than
an average bucket are found by counting; their rows are dealt to as many salts
as they would fill buckets, all other keys have salt 0. There are at most as
many heavy keys as buckets, so their table is broadcast. ``match`` copies the
rows of the other side to the salts of their key and joins on (key, salt): the
facts are read bucket by bucket, and only the other side is shuffled.

The files lie in the shared checkpoint folder under a name of their own, and
``discard`` deletes them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SALT, HEAVY_KEY, SALTS = "_salt", "_heavy_key", "_salts"
ROWS_PER_BUCKET = 4_000_000


@dataclass(frozen=True)
class LaidOut:
    rows: DataFrame
    heavy: DataFrame  # (_heavy_key, _salts), at most one row a bucket
    key: str
    name: str
    buckets: int

    def match(self, left: DataFrame, on: str, cond: Column) -> DataFrame:
        """Inner join of ``left`` with the facts of its ``on`` that satisfy ``cond``."""
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(SALTS, F.lit(1)) - 1))
        copied = (
            left.join(F.broadcast(self.heavy), F.col(on) == F.col(HEAVY_KEY), "left")
            .withColumn("_left_salt", copies).drop(HEAVY_KEY, SALTS))
        facts = self.rows.withColumnRenamed(self.key, "_fact_key").hint("merge")
        out = copied.join(facts, (F.col(on) == F.col("_fact_key")) & (F.col("_left_salt") == F.col(SALT)) & cond)
        return out.drop("_fact_key", "_left_salt", SALT)

    def discard(self) -> None:
        spark = self.rows.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{self.name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def lay_out(df: DataFrame, key: str, buckets: int | None = None) -> LaidOut:
    """``df`` bucketed by ``key``, heavy keys over several buckets.

    The facts are computed once into plain files, counted, and then shuffled
    once into their buckets. Rows without a key match nothing and are left out.
    """
    spark, name = df.sparkSession, f"laid_out_{uuid.uuid4().hex}"
    ensure_checkpoint_dir(spark)
    df = df.where(F.col(key).isNotNull()).checkpoint(eager=True)
    counts = df.groupBy(F.col(key).alias(HEAVY_KEY)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_BUCKET))
    share = max(1, -(-total // buckets))
    heavy = counts.where(F.col("n") > share).select(
        HEAVY_KEY, F.ceil(F.col("n") / share).cast("int").alias(SALTS)).checkpoint(eager=True)
    dealt = F.when(F.col(SALTS).isNotNull(), F.pmod(F.xxhash64(*df.columns), SALTS).cast("int")).otherwise(F.lit(0))
    salted = (
        df.join(F.broadcast(heavy), F.col(key) == F.col(HEAVY_KEY), "left")
        .withColumn(SALT, dealt).select(*df.columns, SALT))
    (salted.repartition(buckets, key, SALT).write.bucketBy(buckets, key, SALT)
     .option("path", f"{ensure_checkpoint_dir(spark)}/{name}").saveAsTable(name))
    return LaidOut(spark.read.table(name), heavy, key, name, buckets)
