"""Near-duplicate vectors by product quantisation.

Vectors go to the inverted list of their nearest coarse centroid; residuals are coded by subspace.
Each vector visits every list that can hold a neighbour: one is left out only where the plane between
its centroid and another one lies farther away than neighbours do.  Table lookups give the inner product
with every coded vector there, and whatever may reach the bound is reranked by the exact cosine.  The
lookup keeps a pair unless its estimate plus the coding error of that vector stays below the bound, so
no link is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, numbered, small

#: Vectors that an inverted list holds on average, and the most lists.  Beyond LISTS * LIST vectors lists grow.
LIST, LISTS = 100, 4096
#: Centroids and codebooks are fitted on at most so many vectors, in the order of a hash.
SAMPLE = 40_000
#: Centroids near a vector whose planes are tried against each list.
PLANES = 6
#: Width of a subspace and codewords of each.
SUBSPACE, WORDS = 4, 32
#: Vectors on each side of one block of work, lists that share a block, and visitors compared at once.
BLOCK, STEP = 4096, 512
GROUP = BLOCK // LIST


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(11)
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centre)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre[count > 0] = total[count > 0] / count[count > 0, None]
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    half = (centre**2).sum(1) / 2
    return np.concatenate([np.zeros(0, np.int64), *((x[i : i + 4096] @ centre.T - half).argmax(1) for i in range(0, len(x), 4096))])


def _units(raw: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, padded to `width`, and their own lengths."""
    dim = np.fromiter((len(b) // 8 for b in raw), np.int64, len(raw))
    out = np.zeros((len(raw), width))
    for d in np.unique(dim):
        at = np.flatnonzero(dim == d)
        out[at, :d] = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), d)
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True), dim


class Codebook:
    """Coarse centroids and one set of codewords for each subspace of the residuals."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.width = sample.shape[1]
        self.centre = _kmeans(sample, min(lists, len(sample)))
        rest = sample - self.centre[_nearest(sample, self.centre)]
        self.cuts = list(range(0, self.width, SUBSPACE))
        self.words = [_kmeans(rest[:, a : a + SUBSPACE], min(WORDS, len(rest)), 6) for a in self.cuts]

    def visits(self, near: np.ndarray, home: np.ndarray, cosine: float) -> np.ndarray:
        """Lists from the home list on that may hold a vector of that cosine to x; near: x @ centre - |centre|^2 / 2.

        A vector of list h is no farther from centroid h than from centroid j, so it lies beyond the
        plane between them, and x is (near_j - near_h) / |centre_j - centre_h| away from that plane.
        """
        k = min(PLANES, near.shape[1])
        order = np.argpartition(-near, k - 1, axis=1)[:, :k]
        reach = np.sqrt(max(2 - 2 * cosine, 0)) + 1e-6
        norm = (self.centre**2).sum(1)
        out = np.arange(near.shape[1])[None, :] >= home[:, None]
        for j in order.T:
            apart = np.sqrt(np.maximum(norm[j][:, None] + norm[None, :] - 2 * self.centre[j] @ self.centre.T, 0))
            out &= near[np.arange(len(j)), j][:, None] - near <= reach * apart + 1e-6
        return out

    def assign(self, x: np.ndarray, cosine: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Home list, groups of lists to visit, codes, and the length of what the codes leave out."""
        near = x @ self.centre.T - (self.centre**2).sum(1) / 2
        home = near.argmax(1)
        groups = [np.unique(np.flatnonzero(v) // GROUP) for v in self.visits(near, home, cosine)]
        rest = x - self.centre[home]
        codes = np.stack([_nearest(np.ascontiguousarray(rest[:, a : a + SUBSPACE]), w) for a, w in zip(self.cuts, self.words, strict=True)], 1).astype(np.uint8)
        coded = np.concatenate([w[codes[:, m]] for m, w in enumerate(self.words)], 1)
        return home, groups, codes, np.linalg.norm(rest - coded, axis=1)

    def lookup(self, x: np.ndarray, home: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Estimated inner products of x with coded vectors of some lists: one table a subspace."""
        lists, at = np.unique(home, return_inverse=True)
        out = (x @ self.centre[lists].T)[:, at]
        for m, (a, w) in enumerate(zip(self.cuts, self.words, strict=True)):
            out += (x[:, a : a + SUBSPACE] @ w.T)[:, codes[:, m]]
        return out


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def block_links(book: Codebook, cosine: float, res: pd.DataFrame, vis: pd.DataFrame) -> tuple[dict, list]:
    """Links of visitors with residents of one group of lists: linked rows of each class, and edges that span what is connected."""
    y, ydim = _units(list(res["vec"]), book.width)
    x, xdim = _units(list(vis["vec"]), book.width)
    codes = np.frombuffer(b"".join(res["code"]), np.uint8).reshape(len(res), -1)
    xcls, ycls = vis["cls"].to_numpy(), res["cls"].to_numpy()
    xhome, yhome = vis["home"].to_numpy(), res["home"].to_numpy()
    least = cosine - res["err"].to_numpy()[None, :] - 1e-9
    ends: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for s in range(0, len(x), STEP):
        c = slice(s, s + STEP)
        ok = book.lookup(x[c], yhome, codes) >= least
        ok &= xdim[c, None] == ydim[None, :]
        # each pair once: from the lower list, and in a shared list by order
        ok &= (xhome[c, None] < yhome[None, :]) | ((xhome[c, None] == yhome[None, :]) & (xcls[c, None] < ycls[None, :]))
        i, j = np.nonzero(ok)
        i += s
        keep = np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", x[i[k : k + 65536]], y[j[k : k + 65536]]) >= cosine for k in range(0, len(i), 65536))])
        ends.append((i[keep], j[keep]))
    i, j = (np.concatenate(e) for e in zip(*ends, strict=True))
    xs, ys = vis["rows"].to_numpy(), res["rows"].to_numpy()
    count: dict = {}
    for cls, n in ((xcls, np.bincount(i, ys[j], len(x))), (ycls, np.bincount(j, xs[i], len(y)))):
        for c, k in zip(cls[n > 0], n[n > 0], strict=True):
            count[int(c)] = count.get(int(c), 0) + int(k)
    reps = np.concatenate([vis["rep"].to_numpy(), res["rep"].to_numpy()])
    root = roots(i, j + len(x), len(reps))
    at = np.unique(np.concatenate([i, j + len(x)]))
    return count, [(int(reps[a]), int(reps[root[a]])) for a in at if reps[a] != reps[root[a]]]


def packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): components as doubles; vec is null where a vector is null, empty, zero or not finite."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            out = []
            for v in b.column(1):
                a = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid else np.zeros(0)
                out.append((a + 0.0).tobytes() if len(a) and np.isfinite(a).all() and a.any() else None)  # + 0.0: one zero
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["vec_id", "vec"])

    return rows.mapInArrow(work, f"vec_id {id_type}, vec binary")


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of `vectors`.

    Two vectors link when their cosine in double precision reaches the bound; n_links counts the other
    rows linked directly, component_id is the smallest vec_id reachable.  Null, empty and zero vectors
    and those with null or non-finite components link with nothing, nor do vectors of different
    lengths or rows without vec_id.  Equal vectors are one class, so repeats make no pairs; rows that
    repeat a vec_id belong to one component.  Long lists are split into blocks on both sides.
    """
    spark = vectors.sparkSession
    rows = numbered(packed(vectors), "r").withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit("second"), "vec")})
    real = rows.where("vec is not null and vec_id is not null")
    # a class is named by one of its rows, and its rows find it by a 128-bit hash
    classes = real.groupBy("h1", "h2", "vec").agg(F.min("r").alias("cls"), F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("rows"))
    classes = materialize(classes, "classes")
    named = classes.select("h1", "h2", "cls")
    real = real.drop("vec").join(named, ["h1", "h2"])
    rows = rows.select("vec_id", F.when(F.col("vec").isNotNull() & F.col("vec_id").isNotNull(), F.col("h1")).alias("h1"), "h2").join(named, ["h1", "h2"], "left")
    total = classes.count()
    counts = classes.select("cls", "rep", "rows")
    if total > 1:
        sample = [bytes(r[0]) for r in classes.orderBy(F.xxhash64(F.lit("pq"), "cls"), "cls").select("vec").limit(SAMPLE).collect()]
        width = classes.agg(F.max(F.octet_length("vec"))).first()[0] // 8
        book = Codebook(_units(sample, width)[0], max(1, min(LISTS, total // LIST)))
        linked = _links(spark, classes, book, cosine)
        links = linked.where("links > 0").groupBy("cls").agg(F.sum("links").alias("links"))
        edges = linked.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
        ties = real.groupBy("vec_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select("vec_id")
        ties = real.join(ties, "vec_id", "left_semi").join(classes.select("cls", "rep"), "cls").select(F.col("vec_id").cast("long").alias("a"), F.col("rep").alias("b"))
        comp = components(edges.unionByName(ties)).select(F.col("node").alias("rep"), "component")
        counts = counts.join(links, "cls", "left").join(comp, "rep", "left")
    else:
        counts = counts.withColumns({"links": F.lit(0).cast("long"), "component": F.col("rep")})
    counts = materialize(counts.select("cls", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("links"), F.coalesce("component", "rep").alias("component")), "counts")
    out = rows.join(counts, "cls", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", F.col("vec_id").cast("long")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(spark, classes: DataFrame, book: Codebook, cosine: float) -> DataFrame:  # noqa: ANN001
    """Rows (cls, links) and (rep, other) of all blocks."""
    sent = spark.sparkContext.broadcast((book.width, book.centre, book.cuts, book.words))  # bounded by LISTS and WORDS

    def restore() -> Codebook:
        out = Codebook.__new__(Codebook)
        out.width, out.centre, out.cuts, out.words = sent.value
        return out

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = restore()
        for b in small(batches):
            if not b.num_rows:
                continue
            home, groups, codes, err = book.assign(_units(b.column(1).to_pylist(), book.width)[0], cosine)
            offsets = pa.array(np.append(0, np.cumsum([len(g) for g in groups])).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(4)), pa.array(home.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(groups).astype(np.int32))), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err)],
                ["cls", "vec", "rep", "rows", "home", "groups", "code", "err"],
            )

    kinds = "cls long, vec binary, rep long, rows long, home int, groups array<int>, code binary, err double"
    table = materialize(classes.select("cls", "vec", "rep", "rows").mapInArrow(assign, kinds), "assigned")
    visits = table.withColumn("list", F.explode("groups")).drop("groups")
    table = table.withColumn("list", F.floor(F.col("home") / GROUP).cast("int")).drop("groups")
    here = table.groupBy("list").agg(F.count("*").alias("nr"))
    there = visits.groupBy("list").agg(F.count("*").alias("nv"))
    size = materialize(here.join(there, "list").select("list", F.ceil(F.col("nr") / BLOCK).cast("int").alias("nr"), F.ceil(F.col("nv") / BLOCK).cast("int").alias("nv")), "lists")
    size = F.broadcast(size)  # at most LISTS / GROUP rows
    part = lambda n: F.pmod(F.col("cls"), F.col(n)).cast("int")
    cells = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shape = ["list", "rb", "vb", "resident", "cls", "vec", "rep", "rows", "home", "code", "err"]
    res = table.join(size, "list").withColumn("rb", part("nr")).withColumn("vb", cells("nv")).withColumn("resident", F.lit(True))
    vis = visits.join(size, "list").withColumn("vb", part("nv")).withColumn("rb", cells("nr")).withColumn("resident", F.lit(False))
    vis = vis.withColumn("code", F.lit(None).cast("binary"))

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        on = pdf["resident"].to_numpy(bool)
        res, vis = pdf[on], pdf[~on]
        if not len(res) or not len(vis):
            return pd.DataFrame({"cls": [], "links": [], "rep": [], "other": []})
        count, edges = block_links(restore(), cosine, res, vis)
        one = pd.DataFrame({"cls": pd.array(list(count), "Int64"), "links": pd.array(list(count.values()), "Int64"), "rep": pd.array([None] * len(count), "Int64"), "other": pd.array([None] * len(count), "Int64")})
        two = pd.DataFrame({"cls": pd.array([None] * len(edges), "Int64"), "links": pd.array([None] * len(edges), "Int64"), "rep": pd.array([e[0] for e in edges], "Int64"), "other": pd.array([e[1] for e in edges], "Int64")})
        return pd.concat([one, two])

    both = res.select(shape).unionByName(vis.select(shape))
    return materialize(both.groupBy("list", "rb", "vb").applyInPandas(cell, "cls long, links long, rep long, other long"), "links")
