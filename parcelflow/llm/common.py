"""What the operators share: shared storage, numbered rows, size-checked broadcasts, components."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its rows were counted and times their width stay below this.
BROADCAST_BYTES = 8 << 20
#: What a row costs in a broadcast table besides its own values.
ROW_OVERHEAD = 64
#: Bytes of an Arrow batch that a task works on at once.
BATCH_BYTES = 2 << 20

#: Deletes the shuffle files of a query once its result is written.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class _Table:
    """A folder in shared storage; `seen` is a weak reference of the JVM to what every plan that reads it holds."""

    spark: SparkSession
    path: str
    seen: object = None


#: Tables without an owner: they go once no plan can read them, or with the process.
_left: list[_Table] = []
_guard = threading.Lock()
#: The tables of the innermost `temporary` block of this thread of control; another thread has its own.
_own: ContextVar[list[_Table] | None] = ContextVar("parcelflow_tables", default=None)
_folders: list[tuple[SparkSession, str]] = []


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of about BATCH_BYTES, so what a task holds doesn't depend on session settings."""
    for b in batches:
        step = max(1, b.num_rows * BATCH_BYTES // max(b.nbytes, 1))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own on a single machine."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("parcelflow.shared.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="parcelflow-")
        spark.conf.set("parcelflow.shared.dir", base)
        _folders.append((spark, base))
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder in shared storage, owned by the `temporary` block around the call."""
    sweep()
    table = _Table(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    own = _own.get()
    if own is None:
        with _guard:
            _left.append(table)
    else:
        own.append(table)
    return table.path


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def sweep() -> None:
    """Deletes tables without an owner that no plan of the JVM refers to any more, so nothing can read them again."""
    with _guard:
        gone = [t for t in _left if t.seen is not None and t.seen.get() is None]
        for t in gone:
            _left.remove(t)
    for t in gone:
        remove(t.spark, t.path)


@atexit.register
def _clean() -> None:
    for spark, path in [(t.spark, t.path) for t in _left] + _folders:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone; the folder is temporary
            return


@contextmanager
def temporary() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes the tables that this thread writes inside when it ends, but for those passed to what it gives.

    Those pass to the block around it, or live as long as some plan reads them.
    """
    outer, own, kept = _own.get(), [], set()
    token = _own.set(own)

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._parcelflow_path)
        return df

    try:
        yield keep
    finally:
        _own.reset(token)
        for t in own:
            if t.path not in kept:
                remove(t.spark, t.path)
            elif outer is not None:
                outer.append(t)
            else:
                with _guard:
                    _left.append(t)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: lineage ends, lost executors lose nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._parcelflow_path = path
    files = out._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().location()
    for t in [*(_own.get() or ()), *_left]:
        if t.path == path:
            t.seen = spark._jvm.java.lang.ref.WeakReference(files)
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table that `materialize` wrote and nothing will read again."""
    if path := getattr(df, "_parcelflow_path", None):
        remove(df.sparkSession, path)


def maybe_broadcast(df: DataFrame, row_bytes: int, more: Column | None = None) -> DataFrame:
    """Hint a broadcast only if the counted rows fit the bound; beyond it Spark shuffles both sides.

    `df` must be cheap to count: a table that `materialize` wrote.  `more` gives the bytes that a row holds
    besides `row_bytes`, where it has values of any length.
    """
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(more), F.lit(0)) if more is not None else F.lit(0)).first()
    return F.broadcast(df) if rows * (row_bytes + ROW_OVERHEAD) + held <= BROADCAST_BYTES else df


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(name: str, df: DataFrame) -> str:
    """A column name that the frame doesn't have."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder with a long that tells its rows apart, also rows that are equal."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u > v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    # every node also keeps the edge to its own minimum
    large = large.unionByName(low.where("u > m").select("u", F.col("m").alias("v"))).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u")
    return (
        small.select("u", F.col("m").alias("v"))
        .unionByName(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        .distinct()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large and small stars (Kiveris et al., SoCC 2014).

    Input: pairs of comparable ids; loops, repeats and nulls are ignored.  Output: one row
    (node, component) for each node of a proper edge, where component is the smallest node reachable.
    Each round is written to the shared folder, and only the latest is kept.  Nothing is collected
    but one fingerprint of the edge set a round, which tells when it no longer changes.
    """
    cur = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    cur, mark = materialize(cur, "edges"), None
    while True:
        now = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first()
        if now == mark:
            break
        mark, last = now, cur
        if not now[0]:
            break
        cur = materialize(_star(last), "edges")
        drop_table(last)
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
