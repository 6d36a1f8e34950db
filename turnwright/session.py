"""Sessions and what queries need of them."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

ARROW_BYTES = 8 << 20
ROOT = str(Path(__file__).resolve().parent.parent)


def local(spark: SparkSession) -> bool:
    """Whether the driver and all tasks are one process, which sees its own folders."""
    return spark.sparkContext.master.split("[")[0] == "local"


def bounded(spark: SparkSession) -> SparkSession:
    """spark, whose Arrow batches have at most ARROW_BYTES (or one row), so that what a Python worker and its task hold doesn't grow with the length of texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < size <= ARROW_BYTES:
        spark.conf.set(name, ARROW_BYTES)
    return spark


def reachable(spark: SparkSession) -> SparkSession:
    """spark, whose Python workers will find this package: by its path, and beyond one process from an archive that Spark ships."""
    context = spark.sparkContext
    if not local(spark) and not getattr(context, "_turnwright_shipped", False):
        archive = Path(tempfile.mkdtemp(prefix="turnwright-")) / "turnwright.zip"  # read by the driver alone, which serves it
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(Path(ROOT, "turnwright").rglob("*.py")):
                z.write(f, f.relative_to(ROOT))
        context.addPyFile(str(archive))
        context._turnwright_shipped = True
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{paths}" if paths else ROOT
    return bounded(spark)


def session(name: str = "turnwright", **conf: str) -> SparkSession:
    """A local session with adaptive execution, for tools and tests."""
    builder = SparkSession.builder.appName(name).config(map={"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", **conf})
    return reachable(builder.getOrCreate())


def _shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only where that is unset and all is one process (tests), a new temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession) -> str:
    """The path of a new folder that the driver and all executors share."""
    return f"{_shared_folder(spark)}/{uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint in the shared folder."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, path: str, **options: str) -> DataFrame:
    """df as Parquet in this folder, read again; the write's shuffle files go when it ends, not when the driver happens to collect its garbage."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(name, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder, which readers take by column; like cut, but smaller and sooner written."""
    return written(df, scratch(df.sparkSession))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of a written table, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Shelf:
    """Tables written to the shared folder that go together when they are no longer read; a task that writes holds at most 16 MB or so of them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def put(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch(self.spark))
        return written(df, self.paths[-1], compression="zstd", **{"parquet.block.size": str(16 << 20)})

    def clear(self) -> None:
        for path in self.paths:
            discard(self.spark, path)
        self.paths = []
