"""A set of tables published at once: all of them, or the set that was there before.

Tables are written to a folder of their run, each finished by a small record of its rows and digest.  When all are there, a
manifest is put in place under the next number, by renaming; readers take the last manifest, so they see one whole set or
the other.  A run of the same name goes on with the tables that are not finished.  Folders of earlier runs are
deleted once the new manifest is there, but for the one before, which readers may still be at.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import delete


def _system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    system, where = _system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []


def _put(spark: SparkSession, path: str, value: dict) -> None:
    """A small file, there as a whole or not at all; raises if there is one of this name."""
    system, where = _system(spark, path)
    _, beside = _system(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = system.create(beside, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    if not system.rename(beside, where):
        system.delete(beside, False)
        raise FileExistsError(path)


def _get(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r[0] for r in spark.read.text(path).collect()))


def digest(table: DataFrame) -> dict[str, str | int]:
    """The number of rows and a sum of their hashes, which does not depend on their order."""
    total = F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)")) if table.columns else F.lit(None)
    rows, found = table.agg(F.count("*"), total).first()
    return {"rows": rows, "digest": str(found)}


def manifests(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(m[1]) for n in _names(spark, root) if (m := re.fullmatch(r"manifest-(\d+)\.json", n)))


def publish(tables: dict[str, DataFrame | Callable[[], DataFrame]], root: str, run: str) -> dict:
    """Write the tables (or what calling them gives, if they aren't finished yet) and put their manifest in place."""
    spark = SparkSession.active()
    folder = f"{root.rstrip('/')}/runs/{run}"
    for name, table in tables.items():
        if f"{name}.json" in _names(spark, folder):
            continue
        rows = table() if callable(table) else table
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        _put(spark, f"{folder}/{name}.json", digest(spark.read.parquet(f"{folder}/{name}")))
    before = manifests(spark, root)
    last = _get(spark, f"{root}/manifest-{before[-1]:06d}.json") if before else None
    value = {"run": run, "tables": {name: _get(spark, f"{folder}/{name}.json") for name in tables}}
    if value != last:
        _put(spark, f"{root}/manifest-{(before or [0])[-1] + 1:06d}.json", value)
        for other in _names(spark, f"{root}/runs"):
            if other not in (run, (last or {}).get("run")):
                delete(spark, f"{root}/runs/{other}")
    return value


def published(spark: SparkSession, root: str, name: str, verify: bool = False) -> DataFrame:
    """A table of the last set; verify: raises if its rows are not those of the manifest."""
    found = manifests(spark, root)
    if not found:
        raise FileNotFoundError(f"nothing is published in {root}")
    value = _get(spark, f"{root}/manifest-{found[-1]:06d}.json")
    table = spark.read.parquet(f"{root}/runs/{value['run']}/{name}")
    if verify and digest(table) != value["tables"][name]:
        raise ValueError(f"{name} of run {value['run']} is not what was published")
    return table
