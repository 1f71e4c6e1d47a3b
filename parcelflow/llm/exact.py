"""Exact deduplication with static binary-fuse filters (Graf and Lemire, 2022).

An immutable snapshot keeps, for each shard of the digest space, one filter of some nine bits a key.
Digests of an incoming batch are screened against the filters; only positives join the snapshot's
exact buckets, and duplicates inside the batch are grouped on their own.  Members of a group are at
last compared byte by byte with the document that stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialize, maybe_broadcast, new_path, numbered, small, temporary, text_of
from .kernel import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys that one filter holds on average, and the fewest shards; more keys mean more shards.
SHARD_KEYS, SHARDS = 50_000, 16
#: A digest of more than this share of all rows is hot; the keys over which its rows are spread.
HOT, PARTS = 1024, 64
_U = np.uint64


def normalised(name: str = "text") -> Column:
    """A-Z lower-cased, all else kept; null counts as empty."""
    return F.translate(text_of(name), UPPER, LOWER)


def _shape(n: int) -> tuple[int, int]:
    """Segment length and number of starting segments for n keys."""
    length = 4 if n < 2 else min(1 << 18, 1 << int(np.floor(np.log(n) / np.log(3.33) + 2.25)))
    factor = 0.0 if n < 2 else max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    return length, max(1, -(-int(round(n * factor)) // length) - 2)


def _slots(keys: np.ndarray, seed: int, length: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys, seed)
    mask = _U(length - 1)
    a = ((h >> _U(32)) * _U(count * length)) >> _U(32)
    b = (a + _U(length)) ^ ((h >> _U(18)) & mask)
    c = (a + _U(2 * length)) ^ (h & mask)
    return np.stack([a, b, c]).astype(np.int64), (h ^ (h >> _U(32))).astype(np.uint8)


def fuse_build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) of a filter over distinct 64-bit keys."""
    n = len(keys)
    length, count = _shape(n)
    size = (count + 2) * length
    for seed in range(1, 200):
        pos, fp = _slots(keys, seed, length, count)
        degree = np.bincount(pos.ravel(), minlength=size)
        who = np.zeros(size, np.int64)
        for row in pos:
            np.bitwise_xor.at(who, row, np.arange(n))
        layers: list[tuple[np.ndarray, np.ndarray]] = []
        left, front = n, np.flatnonzero(degree == 1)
        while len(front):
            key, first = np.unique(who[front], return_index=True)
            layers.append((key, front[first]))
            left -= len(key)
            touched = pos[:, key]
            for row in touched:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(who, row, key)
            near = np.unique(touched)
            front = near[degree[near] == 1]
        if left == 0:
            table = np.zeros(size, np.uint8)
            for key, at in reversed(layers):
                p = pos[:, key]
                table[at] = fp[key] ^ table[p[0]] ^ table[p[1]] ^ table[p[2]]
            return seed, length, count, table.tobytes()
    raise ValueError("no seed peels these keys: they repeat")


def fuse_contains(filter_: tuple[int, int, int, bytes], keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; never false for a key that it holds."""
    seed, length, count, table = filter_
    t = np.frombuffer(table, np.uint8)
    pos, fp = _slots(keys, seed, length, count)
    return (t[pos[0]] ^ t[pos[1]] ^ t[pos[2]]) == fp


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), "<u8")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of each whole normalised text, in Arrow batches."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            # bytes.lower() changes A-Z only
            out = [hashlib.sha256(t.encode("utf-8", "surrogatepass").lower()).digest() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "digest"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(work, f"doc_id {id_type}, digest binary")


def _shard(n: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int").alias("shard")


def build_filters(groups: DataFrame, shards: int) -> DataFrame:
    """One binary-fuse filter for each shard of a snapshot's distinct digests."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(_keys(pdf["digest"]))
        seed, length, count, table = fuse_build(keys)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "seed": [seed], "length": [length], "count": [count], "table": [table]})

    return groups.select("digest", _shard(shards)).groupBy("shard").applyInPandas(build, "shard int, seed int, length int, count int, table binary")


def screen(groups: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The groups of an incoming batch, with `maybe`: false where the snapshot surely lacks the digest."""
    cols = [c for c in groups.columns if c != "digest"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema)

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = left[["digest", *cols]].copy()
        if len(left) == 0 or len(right) == 0:
            out["maybe"] = np.zeros(len(out), bool)
            return out
        r = right.iloc[0]
        out["maybe"] = fuse_contains((int(r["seed"]), int(r["length"]), int(r["count"]), r["table"]), _keys(left["digest"]))
        return out

    batch = groups.select("digest", *cols, _shard(shards))
    return batch.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(probe, f"{kinds}, maybe boolean").select(*groups.columns, "maybe")


def _grouped(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


class Snapshot:
    """An immutable set of known texts in a folder: exact buckets (digest, keep_id, group_size) and a filter a shard."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        """Opens what `write` has written."""
        self.groups, self.filters = spark.read.parquet(f"{path}/groups"), spark.read.parquet(f"{path}/filters")
        self.shards = spark.read.parquet(f"{path}/shape").first()["shards"]

    @classmethod
    def write(cls, groups: DataFrame, path: str, shards: int | None = None) -> Snapshot:
        """Writes a snapshot of distinct digests; a later batch opens it by its path, and its filters are not built again."""
        spark = groups.sparkSession
        groups.select("digest", "keep_id", "group_size").write.parquet(f"{path}/groups")
        stored = spark.read.parquet(f"{path}/groups")
        shards = shards or max(SHARDS, -(-stored.count() // SHARD_KEYS))
        build_filters(stored, shards).write.parquet(f"{path}/filters")
        spark.createDataFrame([(shards,)], "shards int").write.parquet(f"{path}/shape")
        return cls(spark, path)

    def merged(self, batch: DataFrame) -> DataFrame:
        """Groups (digest, keep_id, group_size) of the snapshot and a new batch of groups together."""
        seen = materialize(screen(batch, self.filters, self.shards), "screened")
        hits = seen.where("maybe").drop("maybe")
        both = self.groups.unionByName(hits).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        return both.unionByName(seen.where("not maybe").drop("maybe"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of `docs`.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  The largest doc_id
    of a group stays.  Rows that repeat a doc_id all count in group_size and share its decision; a null
    doc_id is kept only where the whole group has none.  Rows with an even xxhash64(doc_id) are the
    immutable snapshot, the others the incoming batch: the answer doesn't depend on that split.  A
    digest that a third of all rows share is reduced to one row per task before it is counted, and its rows
    are spread over PARTS keys where they meet their group.  An empty table gives no rows; other columns are ignored.
    """
    with temporary() as keep:
        rows = materialize(digests(docs).withColumn("old", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), "digests")
        snapshot = Snapshot.write(_grouped(rows.where("old"), "digest"), new_path(docs.sparkSession, "snapshot"))
        groups = materialize(snapshot.merged(_grouped(rows.where("not old"), "digest")), "groups")
        total = rows.count()
        out = _by_digest(rows, groups, total).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
        out = keep(materialize(out, "exact"))
        differ = not _differing(docs, groups, total).isEmpty()
    if differ:  # two texts with one SHA-256: group by the bytes themselves
        texts = docs.select("doc_id", normalised().alias("norm"))
        by_text = _grouped(texts, "norm")
        out = texts.join(by_text, "norm").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.unhex(F.sha2("norm", 256)).alias("digest"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _by_digest(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """`rows` with the group of their digest.  A digest of more than a HOT-th of all rows is spread over PARTS keys."""
    much = F.col("group_size") * HOT > total
    hot = groups.where(much).select("digest", F.lit(True).alias("hot"))  # fewer than HOT rows, as sizes add up to total
    part = F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))).otherwise(0).cast("int")
    left = rows.join(F.broadcast(hot), "digest", "left").withColumn("part", part).drop("hot")
    parts = F.when(much, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    return left.join(maybe_broadcast(groups.withColumn("part", F.explode(parts)), 60), ["digest", "part"]).drop("part")


def _differing(docs: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Digests that stand for texts of different bytes.  Only members of groups move texts, and each task first
    reduces equal ones to one, so a group of any size arrives as one text a task."""
    texts = docs.select(normalised().alias("norm")).select(F.unhex(F.sha2("norm", 256)).alias("digest"), "norm")
    held = _by_digest(texts, groups.where("group_size > 1").select("digest", "group_size"), total)
    return held.groupBy("digest", "norm").agg(F.lit(1)).groupBy("digest").count().where("count > 1").select("digest")


def drop_exact(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of equal texts: the one with the largest doc_id; all columns stay.

    The decision is made for each row, not for each doc_id: of rows that repeat id and text one stays, an
    id that stands for two texts keeps both, and where no row of a group has an id one of them stays.
    Empty and null texts are equal.
    """
    row = fresh("__pf_row", docs)
    rows = numbered(docs, row)
    with temporary() as keep:
        found = exact_groups(rows.select(F.col(row).alias("doc_id"), "text")).where("group_size > 1").select(F.col("doc_id").alias("r"), F.col("keep_id").alias("g"))
        found = materialize(found.join(rows.select(F.col(row).alias("r"), "doc_id"), "r"), "copies")
        best = found.groupBy("g").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "r")).alias("best"))
        stays = materialize(best.select(F.col("best.r").alias("r")), "stays")
        gone = keep(materialize(found.select("r").join(maybe_broadcast(stays, 8), "r", "left_anti").select(F.col("r").alias(row)), "dropped"))
    return rows.join(maybe_broadcast(gone, 8), row, "left_anti").select(docs.columns)
