"""Near-duplicate documents: MinHash with tensored banding, every link confirmed on full shingle sets.

Two small collections A and B of `tables` band values are computed, each from `rows` minhashes.  The
key of table (i, j) is the pair (A_i, B_j), so 2 * rows * tables minhashes give tables ** 2 tables of
2 * rows values each (the tensoring of Christiani, Pagh and Thorup).  With 3 and 10, a pair of
similarity 0.85 shares a table with probability 0.9998, one of 0.8 with 0.998, one of 0.3 with 0.06.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, drop_table, fresh, materialize, maybe_broadcast, numbered, small, temporary, text_of
from .kernel import U, mix, shingles
from .pq import roots

ROWS, TABLES = 3, 10
#: Documents of a block on average, and shingles of one slice of a membership matrix.
BLOCK, SLICE = 256, 4096


def signatures(docs: DataFrame, words: int, rows: int = ROWS, tables: int = TABLES) -> DataFrame:
    """(doc_id, n, s1, s2, bands): set size, a 128-bit hash of the set, and A then B in one array."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rng = np.random.default_rng(20240229)
    factor = rng.integers(0, 1 << 63, 2 * rows * tables, dtype=np.int64).astype(U) * U(2) + U(1)
    shift = rng.integers(0, 1 << 63, 2 * rows * tables, dtype=np.int64).astype(U)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            sets = list(shingles(b.column(1), words))
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            full = np.flatnonzero(size)
            flat = np.concatenate(sets) if sets else np.zeros((0, 2), U)
            start = (np.cumsum(size) - size)[full]
            low = np.zeros((len(sets), 2 * rows * tables), U)
            s1, s2 = np.zeros(len(sets), U), np.zeros(len(sets), U)
            if len(full):
                s1[full], s2[full] = (np.add.reduceat(mix(flat[:, k].copy(), k + 1), start) for k in (0, 1))
                low[full] = _minima(flat[:, 0].copy(), start, factor, shift)
            band = np.zeros((len(sets), 2 * tables), U)
            for r in range(rows):
                band = mix(band ^ low[:, r::rows], r + 1)
            offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * 2 * tables)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size), *(pa.array(x.view(np.int64)) for x in (s1, s2)), pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(band).view(np.int64).ravel()))],
                ["doc_id", "n", "s1", "s2", "bands"],
            )

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(work, f"doc_id {id_type}, n long, s1 long, s2 long, bands array<long>")


def _minima(flat: np.ndarray, start: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over each set; whole sets at a time, about 64 K values for the cache."""
    out = np.empty((len(start), len(factor)), U)
    end = np.append(start[1:], len(flat))
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + (1 << 16), "right")))
        part, at = flat[start[a] : end[b - 1]], start[a:b] - start[a]
        for k in range(len(factor)):
            out[a:b, k] = np.minimum.reduceat(part * factor[k] + shift[k], at)
        a = b
    return out


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles): the distinct 128-bit shingle hashes of each text, packed."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            sets = list(shingles(b.column(1), words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(work, f"doc_id {id_type}, shingles binary")


def _numbers(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Sets of 128-bit hashes as sets of small numbers, alike where the hashes are."""
    flat = np.concatenate(sets)
    _, at, code = np.unique(flat[:, 0], return_index=True, return_inverse=True)
    if (flat[at[code], 1] != flat[:, 1]).any():  # one first hash, two second ones
        code = np.unique(flat, axis=0, return_inverse=True)[1].ravel()
    return np.split(code, np.cumsum([len(x) for x in sets])[:-1])


def _counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of membership matrices in slices."""
    both = _numbers(a + b)
    if len(a) * len(b) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in both[len(a) :]] for x in both[: len(a)]])
    column = np.concatenate(both)
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    times = np.bincount(column)
    keep = times[column] > 1
    number = np.cumsum(times > 1) - 1
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, int(number[-1]) + 1 if len(number) else 0, SLICE):
        at = slice(*np.searchsorted(column, [lo, lo + SLICE]))
        m = np.zeros((len(both), SLICE), np.float32)
        m[row[at], column[at] - lo] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return np.rint(out).astype(np.int64)


def _cell_links(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> list[tuple]:
    """Edges that span what is linked between two blocks."""
    a, b = ([np.frombuffer(x, U).reshape(-1, 2) for x in side["shingles"]] for side in (left, right))
    c = _counts(a, b)
    union = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :] - c
    i, j = np.nonzero(100 * c >= percent * union)
    ids = [*left["doc_id"], *right["doc_id"]]
    root = roots(i, j + len(a), len(ids))
    return list({(ids[k], ids[root[k]]) for k in range(len(ids)) if ids[k] != ids[root[k]]})


def links_within(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): edges that span the linked pairs among those that share a bucket of `members` (key, rep).

    Documents gather around the smallest id that their buckets lead to, and each gathering is cut into
    blocks of at most about BLOCK.  Blocks whose gatherings share a bucket are compared as a whole, in
    matrices, so candidate pairs are never listed.  Each block meets itself and the first block of each
    gathering first; other cells are skipped where all their documents are connected by then, so a huge
    group of near copies costs its size and not the square of it.
    """
    home = members.groupBy("key").agg(F.min("rep").alias("low"))
    for _ in range(2):
        near = members.join(home, "key").groupBy("rep").agg(F.min("low").alias("home"))
        near = materialize(near, "home")
        home = members.join(near, "rep").groupBy("key").agg(F.min("home").alias("low"))
    size = materialize(near.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
    at = materialize(members.join(near, "rep").select("key", "home").distinct(), "homes")
    mixed = at.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    at = at.join(mixed, "key", "left_semi")
    apart = at.select("key", F.col("home").alias("h1")).join(at.select("key", F.col("home").alias("h2")), "key").where("h1 < h2").select("h1", "h2").distinct()
    pairs = size.select(F.col("home").alias("h1"), F.col("home").alias("h2")).unionByName(apart)
    pairs = pairs.join(size.select(F.col("home").alias("h1"), F.col("blocks").alias("n1")), "h1").join(size.select(F.col("home").alias("h2"), F.col("blocks").alias("n2")), "h2")
    pairs = materialize(pairs, "pairs")
    placed = materialize(near.join(size, "home").select("rep", "home", F.pmod(F.xxhash64("rep"), "blocks").cast("int").alias("block")), "placed")
    named = materialize(near.select(F.col("rep").alias("doc_id")), "named")
    texts = docs.select("doc_id", "text").join(maybe_broadcast(named, 8), "doc_id", "left_semi")
    sets = shingle_sets(texts, words)
    # first every block with itself and with the first block of each gathering that it meets ...
    same, upto = F.col("h1") == F.col("h2"), lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    zero = F.lit(0)
    own = F.concat(F.transform(upto("n1"), lambda k: cell(k, k)), F.transform(upto("n1"), lambda k: cell(zero, k)))
    apart = F.concat(F.transform(upto("n2"), lambda k: cell(zero, k)), F.transform(upto("n1"), lambda k: cell(k, zero)))
    cells = pairs.select("h1", "h2", F.explode(F.array_distinct(F.when(same, own).otherwise(apart))).alias("c")).select("h1", "h2", "c.i", "c.j")
    found = _compared(sets, placed, materialize(cells, "cells"), percent)
    # ... then the cells that are left, unless all that they hold is connected by now
    if pairs.where("n1 > 1 and n2 > 1").isEmpty():
        return found
    comp = components(found)
    root = placed.join(comp, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("component", "rep"))
    blocks = materialize(root.groupBy("home", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi")), "blocks")
    ends = lambda t, x, *keys: t.select(*(F.col(k).alias(n) for k, n in keys), F.col("lo").alias(f"lo{x}"), F.col("hi").alias(f"hi{x}"))
    homes = blocks.groupBy("home").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    mixed = F.least("lo1", "lo2") < F.greatest("hi1", "hi2")
    rest = pairs.where("n1 > 1 and n2 > 1").select("h1", "h2").join(ends(homes, 1, ("home", "h1")), "h1").join(ends(homes, 2, ("home", "h2")), "h2").where(mixed).select("h1", "h2")
    rest = rest.join(ends(blocks, 1, ("home", "h1"), ("block", "i")), "h1").join(ends(blocks, 2, ("home", "h2"), ("block", "j")), "h2")
    rest = rest.where(mixed & (F.col("i") > 0) & (F.col("j") > 0) & (~same | (F.col("i") < F.col("j")))).select("h1", "h2", "i", "j")
    return found.unionByName(_compared(sets, placed, materialize(rest, "rest"), percent))


def _compared(sets: DataFrame, placed: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """(a, b): edges that span what is linked within each cell, block i of h1 against block j of h2, on full sets."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    at = placed.select(F.col("rep").alias("doc_id"), "home", "block")
    left = cells.join(at, (F.col("h1") == F.col("home")) & (F.col("i") == F.col("block"))).withColumn("right", F.lit(False))
    right = cells.where("h1 <> h2 or i <> j").join(at, (F.col("h2") == F.col("home")) & (F.col("j") == F.col("block"))).withColumn("right", F.lit(True))
    rows = materialize(left.unionByName(right).drop("home", "block"), "met")
    bundles = max(1, -(-rows.count() // BLOCK))
    rows = sets.join(rows, "doc_id").withColumn("bundle", F.pmod(F.xxhash64("h1", "h2", "i", "j"), F.lit(bundles)))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for (h1, h2, i, j), cell in pdf.groupby(["h1", "h2", "i", "j"]):
            left, right = cell[~cell["right"]], cell[cell["right"]]
            if h1 == h2 and i == j:
                right = left
            if len(left) and len(right):
                out += _cell_links(left, right, percent)
        return pd.DataFrame(out, columns=["a", "b"])

    return materialize(rows.groupBy("bundle").applyInPandas(work, f"a {kind}, b {kind}"), "linked")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = ROWS, tables: int = TABLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of `docs`.

    Documents link when 100 * intersection >= percent * union of their distinct `words`-word shingles;
    component_id is the smallest doc_id reachable.  A text of fewer words is one shingle; empty, null
    or blank texts have none and link with nothing.  Rows that repeat a doc_id are one document with
    several texts; a row without doc_id links with nothing, has no component and is kept.

    Equal sets collapse to one representative first.  Every pair of representatives that shares a
    bucket is then compared on full sets, in blocks.
    """
    with temporary() as keep:
        return keep(materialize(_near_groups(docs, words, percent, rows, tables), "near"))


def _near_groups(docs: DataFrame, words: int, percent: int, rows: int, tables: int) -> DataFrame:
    sig = materialize(signatures(docs, words, rows, tables), "signatures")
    key = ["n", "s1", "s2"]
    reps = materialize(sig.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "reps")
    # documents that share no value of A or no value of B share no table
    bands = reps.select("rep", F.posexplode("bands").alias("band", "value"))
    shared = bands.groupBy("band", "value").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    live = bands.join(shared, ["band", "value"]).groupBy("rep").agg(F.min("band").alias("lo"), F.max("band").alias("hi")).where(f"lo < {tables} and hi >= {tables}").select("rep")
    live = reps.join(live, "rep", "left_semi").select("rep", "n", F.slice("bands", 1, tables).alias("a"), F.slice("bands", tables + 1, tables).alias("b"))
    keys = live.select("rep", "n", F.posexplode("a").alias("i", "av"), "b").select("rep", "n", "i", "av", F.posexplode("b").alias("j", "bv")).select("rep", "n", F.xxhash64("i", "j", "av", "bv").alias("key"))
    keys = materialize(keys, "keys")
    many = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    members = materialize(keys.join(many, "key", "left_semi"), "members")
    drop_table(keys)
    # one doc_id in several classes ties their representatives
    edges = sig.where("n > 0 and doc_id is not null").join(reps.select(*key, "rep"), key).select("doc_id", "rep")
    ties = edges.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    classes = materialize(edges.distinct(), "classes")
    links = ties.unionByName(classes.where("doc_id <> rep").join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    comp = components(links.unionByName(links_within(docs, members, words, percent)))
    comp = comp.select(F.col("node").alias("rep"), "component")
    of_class = classes.join(comp, "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = sig.select("doc_id", F.col("n").alias("n_shingles")).join(of_class, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each near-duplicate group: the one with the smallest doc_id; all columns stay.

    Every row is a document of its own, so an id that stands for two texts keeps both unless another row
    is near each; of rows that repeat id and text one stays, and rows without id stay only where no row
    of their group has one.  Texts without words are near nothing and stay.
    """
    row = fresh("__pf_row", docs)
    rows = numbered(docs, row)
    with temporary() as keep:
        many = near_groups(rows.select(F.col(row).alias("doc_id"), "text"), words, percent).select(F.col("doc_id").alias("r"), F.col("component_id").alias("g"))
        shared = many.where("r <> g").select("g").distinct()
        found = many.join(shared, "g", "left_semi").join(rows.select(F.col(row).alias("r"), "doc_id"), "r")
        found = materialize(found, "groups")
        stays = found.groupBy("g").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "r")).alias("best")).select(F.col("best.r").alias("r"))
        gone = found.select("r").join(maybe_broadcast(materialize(stays, "stays"), 8), "r", "left_anti").select(F.col("r").alias(row))
        gone = keep(materialize(gone, "dropped"))
    return rows.join(maybe_broadcast(gone, 8), row, "left_anti").select(docs.columns)
