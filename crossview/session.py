"""Session helpers: a tuned local session, and the package on the executors' path."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a context, so that Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_crossview_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="crossview-")
    name = os.path.join(folder, "crossview_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, f"{PACKAGE.name}/{p.relative_to(PACKAGE)}")
    sc.addPyFile(name)
    sc._crossview_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it; only a local session gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a folder and read back: its lineage ends there, and it survives lost executors."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so that its lineage ends there."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shipped(query):
    """The query, with the package sent to the executors first."""

    def run(spark: SparkSession, *args):
        ship_package(spark)
        return query(spark, *args)

    run.__name__ = getattr(query, "__name__", "query")
    run.__doc__ = query.__doc__
    return run


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks: UTC, adaptive execution, no UI."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("crossview")
    settings = {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark
