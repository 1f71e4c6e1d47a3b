"""Substring deduplication by relative Lempel-Ziv parsing against blocks of the corpus itself.

A window of `length` words is judged where its smallest word gram lies (a minimizer), which depends on
the window alone, so equal windows have equal anchors.  The windows around one anchor form a segment;
segments whose anchor stands once in the corpus match nothing.  The different segments of anchors that
repeat are dealt by anchor into reference blocks.  Each block is indexed by a suffix array over its
words, and each of its segments is factored greedily: a factor is the longest run of words that stands
elsewhere in the block too.  Factors of a whole window are duplicate spans; windows that two
neighbouring factors cover together are looked up at the factors' border.  No other block can hold
those windows, so nothing else has to be compared.

Anchors with more different segments than one block should hold are split: each of their windows is a
factor of its own, counted by a key of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small, temporary, text_of
from .kernel import U, mix, span_hashes, words

#: Words of a window, and of the gram that anchors it: a third.
LENGTH = 50
#: Different segments of one anchor that a block takes, words of a block on average, and the fewest blocks.
WIDEST, BLOCK_WORDS, BLOCKS = 1024, 50_000, 64

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _first_minima(values: np.ndarray, size: int) -> np.ndarray:
    """For each i, the place of the first smallest of values[i : i + size]."""
    best, reach = np.arange(len(values)), 1
    while reach < size:
        step = min(reach, size - reach)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        reach += step
    return best


def anchored(lanes: tuple[np.ndarray, np.ndarray], first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, lo, windows, anchor, c1, c2) of each segment: its first word, number of windows, two hashes of its words."""
    gram = max(1, length // 3)
    n = len(lanes[0])
    if n < length:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, U, U, U))
    grams = span_hashes(lanes[0], np.arange(n - gram + 1), np.arange(gram, n + 1))
    low = _first_minima(grams, length - gram + 1)[: n - length + 1]
    text = np.searchsorted(first, np.arange(n - length + 1), "right") - 1
    inside = np.arange(length, n + 1) <= first[text + 1]
    change = np.append(True, (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1])
    at = np.flatnonzero(change & inside)
    end = np.searchsorted(np.flatnonzero(~inside | change), at, "right")
    stops = np.append(np.flatnonzero(~inside | change), len(inside))
    size = stops[end] - at
    stop = at + size + length - 1
    return text[at], at, size, grams[low[at]], span_hashes(lanes[0], at, stop), span_hashes(lanes[1], at, stop)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, k, text): rows are told apart by doc_id and a hash of the text; rows alike in both share their result."""
    return docs.select("doc_id", F.xxhash64(text_of(), F.length(text_of())).alias("k"), text_of().alias("text"))


def segments(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, k, h, c1, c2, lo, n): every segment of every text; h is its anchor, c1 and c2 hash its words."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            *lanes, first = words(b.column(2), 2, fold=False)
            text, lo, size, h, c1, c2 = anchored(tuple(lanes), first, length)
            which = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(which), b.column(1).take(which), *(pa.array(x.view(np.int64)) for x in (h, c1, c2)), pa.array((lo - first[text]).astype(np.int32)), pa.array(size.astype(np.int32))],
                ["doc_id", "k", "h", "c1", "c2", "lo", "n"],
            )

    return rows.mapInArrow(work, f"doc_id {kind}, k long, h long, c1 long, c2 long, lo int, n int")


def _contents(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, c1, c2, times, spread, words): the word hashes, packed, of the segments that `wanted` names by text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            h1, h2, first = words(b.column(0), 2, fold=False)
            both = mix(h1 ^ mix(h2, 1), 2)
            out: list[list] = [[] for _ in range(6)]
            for start, parts in zip(first.tolist(), b.column(1).to_pylist(), strict=False):
                for p in parts:
                    at = start + p["lo"]
                    for column, value in zip(out, (p["h"], p["c1"], p["c2"], p["times"], p["spread"], both[at : at + p["n"] + length - 1].tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:5]), pa.array(out[5], pa.binary())], ["h", "c1", "c2", "times", "spread", "words"])

    fields = ("h", "c1", "c2", "times", "spread", "lo", "n")
    by_text = wanted.groupBy("doc_id", "k").agg(F.collect_list(F.struct(*fields)).alias("parts"))
    once = rows.join(by_text.withColumnsRenamed({"doc_id": "d2", "k": "k2"}), F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("k") == F.col("k2")))
    return once.select("text", "parts").mapInArrow(work, "h long, c1 long, c2 long, times long, spread long, words binary")


def longest(values: np.ndarray, ends: np.ndarray, times: np.ndarray) -> np.ndarray:
    """For each place of the segments that end at `ends`, the words of the longest run there that also stands at another place.

    `times` tells how often each segment stands in the corpus: from two on, its runs to its end stand elsewhere.
    The suffixes are sorted by doubling; the longest common start of a suffix with any other is that with a
    neighbour in the order.  Runs don't pass the end of their segment.
    """
    n = len(values)
    owner = np.searchsorted(ends, np.arange(n), "right")
    left = ends[owner] - np.arange(n)
    # a border after each segment that equals nothing
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64)
    levels, reach, most = [rank], 1, int(left.max(initial=1))
    while reach < most:
        after = np.arange(n) + reach
        second = np.where(left > reach, rank[np.minimum(after, n - 1)] + 1, -owner - 1)  # past the end: unlike any other
        order = np.lexsort((second, rank))
        new = np.append(True, (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        levels.append(rank)
        reach *= 2
    order = np.argsort(rank, kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    same = np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        size = 1 << level
        room = np.minimum(left[np.minimum(a, n - 1)] * (a < n), left[np.minimum(b, n - 1)] * (b < n)) if n else a
        ok = (room >= size) & (same < np.minimum(left[order[:-1]], left[order[1:]]))
        ok[ok] = levels[level][a[ok]] == levels[level][b[ok]]
        same[ok] += size
        a[ok] += size
        b[ok] += size
        spent = (same >= np.minimum(left[order[:-1]], left[order[1:]]))
        a[spent], b[spent] = n, n
    out = np.zeros(n, np.int64)
    np.maximum.at(out, order[:-1], same)
    np.maximum.at(out, order[1:], same)
    return np.where(times[owner] > 1, left, np.minimum(out, left))


def parse(size: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the factors of all segments in order, each parsed greedily from its first word."""
    at = ends - np.diff(np.append(0, ends))
    starts, stops, live = [], [], np.arange(len(ends))
    while len(live):
        step = np.maximum(size[at], 1)
        starts.append(at)
        stops.append(at + step)
        at = at + step
        on = at < ends[live]
        at, live = at[on], live[on]
    start, stop = np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(stops or [np.zeros(0, np.int64)])
    order = np.argsort(start)
    return start[order], stop[order]


def repeated_windows(size: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows that stand elsewhere: those inside a factor, and those at the border of two that are found there."""
    start, stop = parse(size, ends)
    found = [_ranges(start[stop - start >= length], stop[stop - start >= length] - length + 1)]
    # a repeated window lies in two neighbouring factors at most: the second reaches to its end
    first_of = np.append(0, ends[:-1])
    joint = ~np.isin(start[1:], first_of) & (stop[1:] - start[:-1] >= length)
    low = np.maximum(start[:-1][joint], stop[:-1][joint] - length + 1)
    at = _ranges(low, np.minimum(stop[:-1][joint], stop[1:][joint] - length + 1))
    found.append(at[size[at] >= length])
    return np.unique(np.concatenate(found))


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    size = np.maximum(hi - lo, 0)
    return np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _masks(places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each segment, a bit for each of its windows that is repeated."""
    first = np.append(0, ends[:-1])
    owner = np.searchsorted(ends, places, "right")
    out = np.zeros(len(ends), np.int64)
    np.bitwise_or.at(out, owner, np.int64(1) << (places - first[owner]))
    return out


def _block(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """(h, c1, c2, mask) of the segments of one reference block that stand once in the corpus."""
    parts = [np.frombuffer(w, U) for w in pdf["words"]]
    values, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
    size = longest(values, ends, pdf["times"].to_numpy())
    out = pd.DataFrame({"h": pdf["h"], "c1": pdf["c1"], "c2": pdf["c2"], "mask": _masks(repeated_windows(size, ends, length), ends)})
    return out[(pdf["times"] == 1).to_numpy()]


def _single_windows(contents: DataFrame, length: int) -> DataFrame:
    """(h, c1, c2, mask) for segments of split anchors that stand once: every window counted by its own 128-bit key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            parts = [np.frombuffer(w, U) for w in b.column(4).to_pylist()]
            values = np.concatenate(parts) if parts else np.zeros(0, U)
            sizes = np.array([len(p) for p in parts], np.int64)
            first = np.cumsum(sizes) - sizes
            at = _ranges(first, first + sizes - length + 1)
            which = np.repeat(np.arange(len(parts)), sizes - length + 1)
            keys = [span_hashes(v, at, at + length).view(np.int64) for v in (values, mix(values, 7))]
            pick = pa.array(which)
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(pick) for i in range(4)), pa.array(at - first[which]), *map(pa.array, keys)], ["h", "c1", "c2", "times", "off", "w1", "w2"])

    wide = contents.select("h", "c1", "c2", "times", "words").mapInArrow(work, "h long, c1 long, c2 long, times long, off long, w1 long, w2 long")
    wide = materialize(wide, "windows")
    many = wide.groupBy("w1", "w2").agg(F.sum("times").alias("t")).where("t > 1").select("w1", "w2")
    many = materialize(many, "many")
    return wide.where("times = 1").join(many, ["w1", "w2"]).groupBy("h", "c1", "c2").agg(F.bit_or(F.expr("shiftleft(1L, cast(off as int))")).alias("mask"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, k, parts): for each text with repeated windows, where segments with some start and which windows they are."""
    with temporary() as keep:
        rows = _keyed(docs)
        found = materialize(segments(rows, length), "segments")
        often = materialize(found.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "often")
        live = materialize(found.join(often, "h", "left_semi"), "live")
        at = F.struct("doc_id", "k", "lo", "n")
        each = live.groupBy("h", "c1", "c2").agg(F.count("*").alias("times"), F.min(at).alias("at"))
        each = materialize(each.select("h", "c1", "c2", "times", "at.*"), "contents")
        spread = materialize(each.groupBy("h").agg(F.count("*").alias("spread")).where("spread > 1"), "spread")
        contents = materialize(_contents(rows, each.join(spread, "h"), length), "words")
        narrow = contents.where(F.col("spread") <= WIDEST)
        total = narrow.agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
        blocks = max(BLOCKS, int(total / BLOCK_WORDS))
        parsed = narrow.groupBy(F.pmod(F.xxhash64("h"), F.lit(blocks)).alias("block")).applyInPandas(lambda pdf: _block(pdf, length), "h long, c1 long, c2 long, mask long")
        whole = each.where("times > 1").select("h", "c1", "c2", F.expr("shiftleft(1L, n) - 1").alias("mask"))
        part = parsed.unionByName(_single_windows(contents.where(F.col("spread") > WIDEST), length))
        masks = materialize(whole.unionByName(part.where("mask <> 0")), "masks")
        out = live.join(masks, ["h", "c1", "c2"]).groupBy("doc_id", "k").agg(F.collect_list(F.struct("lo", "mask")).alias("parts"))
        return keep(materialize(out, "repeats"))


def _covered(n: int, parts: list[dict], length: int) -> np.ndarray:
    """Which of n words a repeated window covers."""
    edge = np.zeros(n + 1, np.int64)
    for p in parts:
        at = p["lo"] + np.flatnonzero([p["mask"] >> i & 1 for i in range(p["mask"].bit_length())])
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, spans, kept): one row per row of `docs`, with the words that no repeated window covers.

    A word is a run of characters other than blanks and U+0009 to U+000D.  A window of `length` words is
    repeated if its words also start anywhere else, in the same text or another; windows are judged on the
    input, so every copy goes, and copies may overlap.  spans are the runs of covered words (start, end
    exclusive); kept joins the other words by one blank.  Null texts are empty; texts of fewer words lose
    nothing; rows that repeat a doc_id, or have none, are texts like others, and two equal rows make each
    other's windows repeated.  An empty table gives no rows; other columns are not read.  `length` must lie
    between 1 and 90, so that the windows of a segment fit the bits of a long.
    """
    if not 1 <= length <= 90:
        raise ValueError("length must lie between 1 and 90")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = repeated_spans(docs, length).withColumnsRenamed({"doc_id": "d2", "k": "k2"})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            counts, spans, kept = [], [], []
            for text, parts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                own = _WORD.findall(text)
                counts.append(len(own))
                gone = _covered(len(own), parts or [], length)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append([{"start": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                kept.append(" ".join(own if not len(edge) else [w for w, g in zip(own, gone.tolist(), strict=True) if not g]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())], ["doc_id", "n_words", "spans", "kept"])

    rows = _keyed(docs).join(found, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("k") == F.col("k2")), "left")
    return rows.select("doc_id", "text", "parts").mapInArrow(work, f"doc_id {kind}, n_words long, spans array<struct<start: long, end: long>>, kept string")


def n_removed(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def digest(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of `without_repeats`."""
    return without_repeats(docs, length).select("doc_id", "n_words", n_removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
