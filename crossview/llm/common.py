"""Helpers shared by the training-data operators: folds, shared storage, bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_folder, remove_folder, written


def fold(column: str | Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets`` (null ids fall in fold 0)."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.crc32(F.encode(col.cast("string"), "UTF-8")) % F.lit(buckets), F.lit(0)).cast("int")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path below the folder that driver and executors share, as the session names it."""
    return fresh_folder(spark, tag)


def stash(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    return written(df, path or fresh_path(df.sparkSession, tag))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared folder once nothing reads it any more."""
    remove_folder(spark, path)


def text_verdict(docs: DataFrame, decide, kind: str = "boolean") -> Column:
    """A column made by ``decide`` (an Arrow array of texts to one of results) from ``docs.text``.

    Only the texts go to Python and only the results come back; the other
    columns stay where they are, so a row is never sent through Arrow as a whole.
    """
    return F.arrow_udf(decide, kind)(F.coalesce(F.col("text"), F.lit("")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_sample(labels: DataFrame, label: str, keep: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each label value, in a fixed pseudo-random order of the id.

    Rows with a null id or label do not count; an id labelled more than once
    takes its largest label. The result has at most ``2 * per_class`` rows, so
    it may be broadcast.
    """
    rows = (
        labels.where(keep & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    order = [F.xxhash64(F.col("doc_id"), F.lit(17)), F.col("doc_id")]
    ones = rows.where("label = 1").orderBy(*order).limit(per_class)
    zeros = rows.where("label = 0").orderBy(*order).limit(per_class)
    return ones.unionByName(zeros)
