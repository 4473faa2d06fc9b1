"""Rebuilt tables whose versions share the days that did not change.

A version is a manifest: for each day the folder its files are in, and the state of the inputs it was made from. A rebuild
writes only the days that changed and a new manifest that points the others to where they are. A manifest becomes visible
at once, under a number that one writer alone can claim. A writer that finds another version when it is done starts again
from that one; a version is always whole for the inputs it names, so what two writers at once may leave undone is found by
the next rebuild. Readers keep the version they began with until `clean` is told that it can go.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarspark.sources.store import deleted, write_days

WIDTH = 12  # digits of a version's number


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    folder, fs = _path(spark, f"{table}/versions")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, table: str, version: int) -> dict:
    """{"days": day -> folder, "inputs": day -> what it was made from}: as many entries as there are days."""
    text = spark.read.text(f"{table}/versions/{version:0{WIDTH}d}.json", wholetext=True).first()[0]
    return json.loads(text)


def _claimed(spark: SparkSession, table: str, version: int) -> bool:
    """Take a number for this writer; false if another one has it."""
    place, fs = _path(spark, f"{table}/versions/{version:0{WIDTH}d}.claim")
    try:
        fs.create(place, False).close()
        return True
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise


def _publish(spark: SparkSession, table: str, version: int, content: dict) -> None:
    """Write a manifest beside its name and move it there, so that no reader sees a part of it."""
    draft, fs = _path(spark, f"{table}/versions/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    if not fs.rename(draft, _path(spark, f"{table}/versions/{version:0{WIDTH}d}.json")[0]):
        raise RuntimeError(f"version {version} of {table} could not be published")


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """A version, the newest by default."""
    known = versions(spark, table)
    if not known:
        raise ValueError(f"no complete version of {table}")
    content = manifest(spark, table, known[-1] if version is None else version)
    folders = sorted(set(content["days"].values()))
    if not folders:
        raise ValueError(f"no day in {table}")
    return spark.read.option("basePath", f"{table}/data").parquet(*folders).drop("load")


def rebuild(
    spark: SparkSession,
    table: str,
    day: str,
    inputs: Mapping[str, str],
    build: Callable[[Sequence[str]], DataFrame],
    cluster: Sequence[str] = (),
) -> list[str]:
    """Bring the table up to `inputs` (day -> state of what it is made from) and return the days that were built.

    `build` gives the rows of some days. Days that are gone from the inputs go from the table; a day without rows has no
    folder. The days of a table are as many as the calendar has, so manifests are small.
    """
    while True:
        known = versions(spark, table)
        last = known[-1] if known else 0
        old = manifest(spark, table, last) if known else {"days": {}, "inputs": {}}
        changed = sorted(d for d, state in inputs.items() if old["inputs"].get(d) != state)
        gone = [d for d in old["inputs"] if d not in inputs]
        if known and not changed and not gone:
            return []
        number = last + 1
        while not _claimed(spark, table, number):
            number += 1
        days = {d: f for d, f in old["days"].items() if d in inputs and d not in changed}
        if changed:
            load = f"{table}/data/load={uuid.uuid4().hex}"
            rows = build(changed)
            write_days(rows.where(F.col(day).cast("string").isin(changed)), load, day, cluster)
            folder, fs = _path(spark, load)
            written = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
            days |= {n.partition("=")[2]: f"{load}/{n}" for n in written if n.startswith(f"{day}=")}
        if versions(spark, table)[-1:] == known[-1:]:
            _publish(spark, table, number, {"days": days, "inputs": dict(inputs)})
            return changed
        # Another writer was first: its version is the one to start from. What was written here is left to `clean`.


def clean(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Delete all but the newest `keep` versions and the folders none of those points to; not while a rebuild runs."""
    known = versions(spark, table)
    kept, old = known[-keep:], known[:-keep]
    used = {f for v in kept for f in manifest(spark, table, v)["days"].values()}
    for v in old:
        deleted(spark, f"{table}/versions/{v:0{WIDTH}d}.json")
    folder, fs = _path(spark, f"{table}/data")
    idle = []
    for load in fs.listStatus(folder) if fs.exists(folder) else []:
        for d in fs.listStatus(load.getPath()):
            place = f"{table}/data/{load.getPath().getName()}/{d.getPath().getName()}"
            if d.isDirectory() and place not in used:
                deleted(spark, place)
                idle.append(place)
    return idle


def loads_by_day(table: DataFrame, day: str) -> dict[str, str]:
    """Day -> names of the load folders its rows are in: what changes when an upsert touches the day."""
    load = F.regexp_extract(F.col("_metadata.file_path"), ".*/load_([0-9a-f]+)/", 1)
    rows = table.select(F.col(day).cast("string").alias("day"), load.alias("load")).distinct()
    return {r["day"]: r["loads"] for r in rows.groupBy("day").agg(F.array_join(F.array_sort(F.collect_set("load")), ",").alias("loads")).collect()}
