"""Session, table access and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: settings that every operator relies on; sizes are left to the cluster
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "corpusloom", **conf: str) -> SparkSession:
    """A session on this machine for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    base = CONF | {"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to the Python workers of all executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("corpusloom", os.path.relpath(full, root)))
    sc.addPyFile(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; one of our own only where none is named, as in tests."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints")
    sc.setCheckpointDir(named)
    return named


def durable(df: DataFrame) -> DataFrame:
    """Writes the rows to the checkpoint folder and cuts the lineage: lost executors don't cost them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def folder(spark: SparkSession, name: str) -> str:
    """A new path for a written table under the shared folder; it is deleted when the application ends."""
    path = f"{checkpoint_dir(spark)}/corpusloom-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Like durable, for wide rows: written as a table of columns, so that later steps read only those they need."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Gives a table of few files at least one partition per core before costly work; larger inputs stay as they lie."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
