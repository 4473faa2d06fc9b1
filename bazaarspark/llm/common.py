"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarspark.session import shared_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers started from another folder import this package (a cluster installs it or takes --py-files)."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = ROOT + (os.pathsep + known if known else "")


def arrow(df: DataFrame, work, schema: str) -> DataFrame:
    """`df.mapInArrow` with workers that can import this package and keep little between tasks."""
    importable(df.sparkSession)
    return df.mapInArrow(released(work), schema)


_kept: dict = {}  # in a worker: the table that its work needs again in its next task


def kept(make, *args):
    """`make(*args)`, kept for the next task of this worker until it is given other work."""
    key = (make, args)
    if key not in _kept:
        _kept[key] = make(*args)
    return _kept[key]


def released(work):
    """`work` for workers that are used again: what other work has kept goes before it, freed memory goes back after it."""
    owner = f"{work.__module__}.{work.__qualname__}"

    def run(batches):
        begin(owner)
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def begin(owner: str) -> None:
    if _kept.get("owner") != owner:
        _kept.clear()
        _kept["owner"] = owner


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect(1)  # not through the tables that are kept
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the checkpoint folder that driver and executors share."""
    return f"{shared_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: lineage is cut and a lost executor loses nothing."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the files of a table made by `written` that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc32_of(column: str) -> Column:
    """crc32 of a value written as decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken, in any case of letters."""
    known = {t.lower() for t in taken}
    while name in known:
        name = "_" + name
    return name


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The whole texts of a batch; null is the empty text."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def some_bytes(batches, column: str | int = "text", most: int = 4 << 20):
    """Slices of Arrow batches that hold about `most` bytes of text each (one text at least)."""
    for batch in batches:
        start, size = 0, 0
        lengths = batch.column(column)
        for i in range(batch.num_rows):
            n = len(lengths[i].as_buffer() or b"") if lengths[i].is_valid else 0
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


@contextlib.contextmanager
def no_garbage():
    """Work that makes no reference cycles, without the collector's walks through large caches."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    most: int,
    longest: int = 1 << 20,
    most_bytes: int = 64 << 20,
) -> list[tuple[str, int]]:
    """At most `most` (text, label) pairs of labelled rows that `learn` allows, by a digest of their ids: bounded work.

    Half the bound belongs to each class, so a rare class is not lost. Texts of more than `longest` bytes are not learnt
    from (they are scored like all others), nor are those that no longer fit into `most_bytes` of all texts together.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learn)
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .distinct()
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"), F.col("label"))
    picked = None
    for value in (0, 1):
        some = known.filter(F.col("label") == value).orderBy(*order).limit(most // 2)
        picked = some if picked is None else picked.union(some)
    # At most `most` small rows: a broadcast of proven size.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.octet_length("text") <= longest)
    rows = texts.join(F.broadcast(picked), "doc_id").withColumn("tie", F.xxhash64("doc_id", "text"))
    # Sizes first: what is brought to the driver is chosen before its texts are.
    sizes = rows.select("tie", "doc_id", "label", F.octet_length("text").alias("n")).orderBy("tie", "doc_id", "label")
    chosen, left = [], most_bytes
    for r in sizes.limit(most).collect():
        if r["n"] <= left:
            chosen.append((r["tie"], r["doc_id"], r["label"]))
            left -= r["n"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    taken = docs.sparkSession.createDataFrame(sorted(set(chosen)), f"tie bigint, doc_id {kind}, label int")
    found = rows.join(F.broadcast(taken), ["tie", "doc_id", "label"]).select("tie", "doc_id", "label", "text").collect()
    # Equal rows of one document are counted as often as they were chosen.
    by_key = {(r["tie"], r["doc_id"], r["label"]): r["text"] for r in found}
    return [(by_key[k], k[2]) for k in chosen]


class Remembered(dict):
    """Values by key for the lists at hand, at most about `most` of them.

    When half of the room is used, the values become the old ones; those that are met again move back, so frequent keys
    stay and rare ones go.
    """

    def __init__(self, most: int, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.most, self.fixed, self.old = most, dict(fixed or {}), {}

    def make_room(self) -> None:
        if len(self) > self.most // 2:
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)

    def missing(self, lists) -> list:
        """The different keys of the lists that have no value; the others are found by plain lookup from here on."""
        absent = {k for keys in lists for k in keys if k not in self}
        back = absent & self.old.keys()
        self.update((k, self.old[k]) for k in back)
        return list(absent - back)
