"""Polygon layers as ESRI shapefiles: files are rows of bytes, so a layer is written and read by many tasks."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
#: Fixed values of the format: file code, version, shape type of polygons.
CODE, VERSION, POLYGON = 9994, 1000, 5
#: Polygons of a file that is written.
ROWS = 50_000


def _header(length: int, box: list[float]) -> bytes:
    return struct.pack(">7i", CODE, 0, 0, 0, 0, 0, length // 2) + struct.pack("<2i8d", VERSION, POLYGON, *box, 0, 0, 0, 0)


def _record(rings: list[np.ndarray]) -> tuple[bytes, list[float]]:
    """A polygon of closed rings, and its box."""
    points = np.concatenate(rings)
    box = [*points.min(0), *points.max(0)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rings])[:-1]])
    return struct.pack("<i4d2i", POLYGON, *box, len(rings), len(points)) + starts.astype("<i4").tobytes() + points.astype("<f8").tobytes(), box


def _records(x: np.ndarray, y: np.ndarray, count: np.ndarray) -> tuple[list[bytes], np.ndarray, list[float]]:
    """Records of rings without closing points, made clockwise and closed; their lengths in words, and the box of all."""
    start = np.cumsum(count) - count
    after = np.arange(len(x)) + 1
    after[start + count - 1] = start
    back = np.add.reduceat(x * y[after] - x[after] * y, start) > 0
    box = np.stack([f.reduceat(v, start) for f in (np.minimum, np.maximum) for v in (x, y)], 1)
    words = 24 + 8 * (count + 1)
    out: list[bytes] = [b""] * len(count)
    for n in np.unique(count):  # rings of one length are one matrix
        at = np.flatnonzero(count == n)
        k = np.append(np.arange(n), 0)
        of = start[at, None] + np.where(back[at, None], n - 1 - k, k)
        record = np.zeros(len(at), [("number", ">i4"), ("words", ">i4"), ("kind", "<i4"), ("box", "<f8", 4), ("parts", "<i4"), ("points", "<i4"), ("start", "<i4"), ("xy", "<f8", (n + 1, 2))])
        record["number"], record["words"], record["kind"], record["parts"], record["points"] = at + 1, words[at], POLYGON, 1, n + 1
        record["box"], record["xy"] = box[at], np.stack([x[of], y[of]], 2)
        data, size = record.tobytes(), record.itemsize
        for i, j in enumerate(at.tolist()):
            out[j] = data[i * size : (i + 1) * size]
    return out, words, [*box[:, :2].min(0), *box[:, 2:].max(0)]


def _table(rows: pd.DataFrame, columns: list[str]) -> bytes:
    """dBASE III: numbers of 24 places, six of them decimal."""
    fields = b"".join(struct.pack("<11sc4xBB14x", c[:10].encode(), b"N", 24, 6) for c in columns)
    head = struct.pack("<4BIHH20x", 3, 100, 1, 1, len(rows), 33 + 32 * len(columns), 1 + 24 * len(columns))
    body = b"".join(b" " + b"".join((b"%24.6f" % v if pd.notna(v) else b" " * 24) for v in r) for r in rows[columns].itertuples(index=False))
    return head + fields + b"\r" + body + b"\x1a"


def encode(df: DataFrame, layer: str, columns: list[str]) -> DataFrame:
    """(layer, part, shp, shx, dbf): files of about ROWS polygons of (layer, ring, numeric columns).

    Rings have no closing point and three points at least; others are left out.  A layer without rows has no file:
    `empty` makes one.  Ring order and closing follow the format.
    """
    count = df.count()
    parts = max(1, -(-count // ROWS))
    rows = df.where(F.size("ring") >= 3).select(F.col(layer).cast("string").alias("layer"), "ring", *(F.col(c).cast("double").alias(c) for c in columns))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("ring", *columns), F.lit(parts)).cast("int"))

    def write(table: pa.Table) -> pa.Table:
        rings = pa.concat_arrays(table.column("ring").chunks)
        x, y = (c.to_numpy(zero_copy_only=False).astype(float) for c in rings.flatten().flatten())
        shp, words, box = _records(x, y, rings.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        places = np.zeros(len(words), [("at", ">i4"), ("words", ">i4")])
        places["at"], places["words"] = 50 + np.cumsum(words + 4) - (words + 4), words
        files = [_header(100 + len(body), box) + body for body in (b"".join(shp), places.tobytes())]
        own = {"layer": table.column("layer")[0].as_py(), "part": table.column("part")[0].as_py(), "shp": files[0], "shx": files[1], "dbf": _table(table.select(columns).to_pandas(), columns)}
        return pa.table([pa.array([v], t) for v, t in zip(own.values(), (pa.string(), pa.int32(), *(pa.binary(),) * 3), strict=True)], names=list(own))

    return rows.groupBy("layer", "part").applyInArrow(write, "layer string, part int, shp binary, shx binary, dbf binary")


def empty() -> bytes:
    """A layer without polygons."""
    return _header(100, [0.0] * 4)


def _inside(point: np.ndarray, ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    crosses = (a[:, 1] > point[1]) != (b[:, 1] > point[1])
    rise = np.where(crosses, b[:, 1] - a[:, 1], 1.0)
    return bool((crosses & (point[0] < a[:, 0] + (point[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / rise)).sum() % 2)


def _parts(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Clockwise rings begin parts; the others are holes of the first part that holds them, or parts if none does."""
    if len(rings) == 1:
        return [rings]
    turn = [float((r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum()) for r in rings]
    out = [[r] for r, t in zip(rings, turn, strict=True) if t <= 0]
    for r, t in zip(rings, turn, strict=True):
        if t > 0:
            home = next((p for p in out if _inside(r[0], p[0])), None)
            if home is None:
                out.append([r])
            else:
                home.append(r)
    return out


def polygons_of(content: bytes) -> Iterator[tuple[int, list[list[np.ndarray]]]]:
    """(record number, parts of closed rings) of a file; null shapes have no parts."""
    if len(content) < 100 or struct.unpack(">i", content[:4])[0] != CODE:
        raise ValueError("not a shapefile")
    at = 100
    while at + 12 <= len(content):
        number, words = struct.unpack_from(">2i", content, at)
        kind = struct.unpack_from("<i", content, at + 8)[0]
        if kind == 0:
            yield number, []
        elif kind in (5, 15, 25):  # with z or m behind the points, which are left out
            parts, points = struct.unpack_from("<2i", content, at + 44)
            starts = [*np.frombuffer(content, "<i4", parts, at + 52), points]
            xy = np.frombuffer(content, "<f8", 2 * points, at + 52 + 4 * parts).reshape(-1, 2)
            yield number, _parts([xy[a:b] for a, b in zip(starts, starts[1:], strict=False) if b - a > 3])
        else:
            raise ValueError(f"shape type {kind} is no polygon")
        at += 8 + 2 * words


def decode(files: DataFrame) -> DataFrame:
    """(path, record, parts) of (path, content); the format ends a file at 2 GB, and a task reads one at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = lambda groups, values: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, groups)]).astype(np.int32)), values)
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                records = polygons_of(content.as_py())
                while some := list(islice(records, 4096)):
                    parts = [p for _, own in some for p in own]
                    rings = [r for p in parts for r in p]
                    xy = np.concatenate([np.zeros((0, 2)), *rings])
                    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
                    nested = lists([own for _, own in some], lists(parts, lists(rings, points)))
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(some), pa.string()), pa.array([n for n, _ in some], pa.int32()), nested], ["path", "record", "parts"])

    return files.select("path", "content").mapInArrow(read, f"path string, record int, parts array<array<array<{POINT}>>>")


def read_layers(spark: SparkSession, folder: str, system: str) -> DataFrame:
    """Polygons of all shapefiles of a folder.  Each must have a .prj whose system has this name; nothing is converted.

    A layer without or of another system and a folder without polygons are errors.
    """
    stem = lambda c: F.regexp_replace(c, r"\.[^./]*$", "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{shp,SHP}").load(folder)
    names = spark.read.option("pathGlobFilter", "*.{prj,PRJ}").text(folder, wholetext=True)
    names = names.select(stem(F.col("_metadata.file_path")).alias("s"), F.regexp_extract("value", r'^\s*PROJCS\["([^"]*)"', 1).alias("system"))
    paths = files.select(F.col("path")).withColumn("s", stem(F.regexp_replace("path", "^file:/+", "file:///")))
    known = paths.join(names.withColumn("s", F.regexp_replace("s", "^file:/+", "file:///")), "s", "left")
    wrong = known.where(F.col("system").isNull() | (F.col("system") != system)).select("path").limit(5).collect()  # names for the message
    if wrong:
        raise ValueError(f"not in {system}: {[r.path for r in wrong]}")
    out = decode(files)
    if out.where(F.size("parts") > 0).isEmpty():
        raise ValueError(f"no polygons in {folder}")
    return out


def cleaning_counts(shapes: DataFrame, valid: Column) -> DataFrame:
    """(n, empty, invalid, kept) of the steps that clean a layer."""
    none = F.coalesce(F.size("parts"), F.lit(0)) <= 0
    return shapes.agg(F.count("*").alias("n"), F.count_if(none).alias("empty"), F.count_if(~none & ~valid).alias("invalid"), F.count_if(~none & valid).alias("kept"))
