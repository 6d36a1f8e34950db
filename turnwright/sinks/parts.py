"""Tables published by partition (K9): a write replaces the partitions that it has rows of, and nothing else, in one step.

Data files are never changed. A write puts its partitions in a folder of its own; a manifest, numbered and never changed either, says in which folder each
partition now stands. A writer adds the next manifest by a rename that fails if another writer was first; it then starts from that one's manifest, so writes of different
partitions keep each other, and of one partition the later write stays. Readers take the last manifest, and their files stay until `vacuum` finds them old.
"""

from __future__ import annotations

import json
import time
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from turnwright.sinks.gate import Gate

#: Writers that may be first, one after the other, before a write gives up.
ATTEMPTS = 100


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _store(spark: SparkSession, path: str):
    return _hadoop(spark).Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = _store(spark, path).globStatus(_hadoop(spark).Path(f"{path}/_manifests/*.json")) or []
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found)


def _manifest(spark: SparkSession, path: str, number: int) -> dict:
    source = _store(spark, path).open(_hadoop(spark).Path(f"{path}/_manifests/{number:012d}.json"))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def _add(spark: SparkSession, path: str, number: int, manifest: dict) -> bool:
    """Whether the manifest is now the one of that number; False if there was one."""
    fs, place = _store(spark, path), _hadoop(spark).Path
    new, name = place(f"{path}/_manifests/.{uuid4().hex}"), place(f"{path}/_manifests/{number:012d}.json")
    out = fs.create(new)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    context = _hadoop(spark).FileContext.getFileContext(name.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(_hadoop(spark).Options.Rename, 0)
    try:
        context.rename(new, name, options)
    except Py4JJavaError as e:
        fs.delete(new, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def latest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """The number of the last manifest, and the manifest; 0 and None before the first."""
    numbers = _numbers(spark, path)
    return (numbers[-1], _manifest(spark, path, numbers[-1])) if numbers else (0, None)


def replace(df: DataFrame, path: str, by: list[str], gate: Gate | None = None) -> int:
    """K9: df's partitions in place of those published at path; returns the manifest's number. gate: rules that df's rows must keep, else nothing is published."""
    spark, version = df.sparkSession, f"turnwright_version=v-{uuid4().hex}"
    folder = f"{path}/data/{version}"
    (gate.watch(df) if gate else df).write.partitionBy(*by).parquet(folder)
    fs = _store(spark, path)
    try:
        if gate:
            gate.verdict()
        root = fs.makeQualified(_hadoop(spark).Path(folder)).toString()
        found = fs.globStatus(_hadoop(spark).Path(folder + "/*=*" * len(by))) or []
        own = {f.getPath().toString().removeprefix(root).lstrip("/"): version for f in found}
        schema = df.select(*[c for c in df.columns if c not in by], *by).schema
        for _ in range(ATTEMPTS):
            number, before = latest(spark, path)
            if before and before["by"] != by:
                raise ValueError(f"{path} is dealt by {before['by']}")
            if _add(spark, path, number + 1, {"by": by, "schema": schema.json(), "parts": (before["parts"] if before else {}) | own}):
                return number + 1
        raise RuntimeError(f"{ATTEMPTS} other writers were first")
    except Exception:
        fs.delete(_hadoop(spark).Path(folder), True)
        raise


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """What is published at path, or was by the manifest of a number; None before the first."""
    manifest = latest(spark, path)[1] if number is None else _manifest(spark, path, number)
    if manifest is None:
        return None
    schema = StructType.fromJson(json.loads(manifest["schema"]))
    if not manifest["parts"]:
        return spark.createDataFrame([], schema)
    places = [f"{path}/data/{version}/{part}" for part, version in manifest["parts"].items()]
    return spark.read.schema(StructType([*schema.fields]).add("turnwright_version", "string")).option("basePath", f"{path}/data").parquet(*places).drop("turnwright_version")


def vacuum(spark: SparkSession, path: str, hours: float = 24) -> int:
    """Drop folders that no manifest but old ones names, and old manifests; the last manifest stays. Returns how many folders went. Only what `replace` wrote is looked at."""
    fs, numbers, before = _store(spark, path), _numbers(spark, path), (time.time() - hours * 3600) * 1000
    place = lambda n: _hadoop(spark).Path(f"{path}/_manifests/{n:012d}.json")
    old = [n for n in numbers[:-1] if fs.getFileStatus(place(n)).getModificationTime() < before]
    used = {v for n in numbers if n not in old for v in _manifest(spark, path, n)["parts"].values()}
    gone = 0
    for f in fs.globStatus(_hadoop(spark).Path(f"{path}/data/turnwright_version=v-*")) or []:
        if f.getPath().getName() not in used and f.getModificationTime() < before:
            gone += bool(fs.delete(f.getPath(), True))
    for n in old:
        fs.delete(place(n), False)
    return gone
