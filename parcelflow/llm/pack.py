"""Packing along a space-filling curve: neighbouring documents share training sequences.

A document's hashed bag of tokens is projected to a few dimensions, its Hilbert key orders the corpus,
and sequences are cut from that order without gaps, so only the last one may be padded.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small, temporary, text_of
from .kernel import PieceEncoder, classes, runs_of, worker_cache

LENGTH, END = 2048, 1
#: Bins of the hashed vector, dimensions and bits a dimension of the curve.
BINS, DIMS, BITS = 256, 4, 15


def _encoder(path: str, kinds: tuple) -> PieceEncoder:
    def make() -> PieceEncoder:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        plain.encode_special_tokens = True
        added = t.get_added_tokens_decoder()
        if any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added.values()):
            raise ValueError("added tokens that depend on their surroundings are not known here")

        def ids_of(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            got = plain.encode(pieces, is_pretokenized=True, add_special_tokens=False)  # each piece a word of its own
            return np.array(got.ids, np.int32), np.bincount(np.array(got.word_ids, np.int64), minlength=len(pieces))

        return PieceEncoder(ids_of, np.repeat(kinds[1], kinds[0]), {a.content: i for i, a in added.items()})

    return worker_cache(("tokenizers", path), make)


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Character classes of the library's own regex engine, probed once by the driver."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return worker_cache("onig kinds", lambda: runs_of(classes(lambda regex, text: "".join(t for t, _ in Split(Regex(regex + "+"), "removed", invert=True).pre_tokenize_str(text)))))


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points with integer coordinates below 2**bits (Skilling, 2004)."""
    x = points.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = key << 1 | (row >> b & 1)
    return key


def _curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed count vectors."""
    v = np.log1p(vectors)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    v = v / np.where(norm == 0, 1, norm)
    plane = np.random.default_rng(7).standard_normal((BINS, DIMS))
    at = np.clip((v @ plane + 4) / 8, 0, 1) * ((1 << BITS) - 1)
    return hilbert(at.astype(np.int64), BITS)


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, n, curve): ids with the end id as little-endian 16-bit integers, or 32-bit where the
    vocabulary is larger, their number, the Hilbert key."""
    id_type, kinds = docs.schema["doc_id"].dataType.simpleString(), _kinds()
    kind = _id_type(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, kinds)
        for b in small(batches):
            ids = encode(b.column(1).to_pylist())
            bag = np.zeros((len(ids), BINS))
            for k, x in enumerate(ids):
                bag[k] = np.bincount((x * 40503 >> 4) % BINS, minlength=BINS)
            raw = [np.append(x, END).astype(kind).tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.array([len(x) + 1 for x in ids], pa.int64()), pa.array(_curve_keys(bag))], ["doc_id", "ids", "n", "curve"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(work, f"doc_id {id_type}, ids binary, n long, curve long")


def _id_type(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def along_curve(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, ids, range, run) in ranges of the curve, with the tokens before each in its range, and
    (range, base), the tokens before each range.

    Documents move once, to the range they belong to; each range is summed as it streams by, and only one
    number a range goes to the driver.
    """
    kind = table.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, before = TaskContext.get().partitionId(), 0
        for b in batches:
            upto = before + np.cumsum(b.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.full(len(upto), at, np.int32)), pa.array(upto - b.column(2).to_numpy())], ["doc_id", "ids", "n", "range", "run"])
            before = int(upto[-1]) if len(upto) else before

    order = ["curve", "doc_id", "row"]
    sorted_ = table.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids", "n")
    ranged = materialize(sorted_.mapInArrow(work, f"doc_id {kind}, ids binary, n long, range int, run long"), "ranged")
    base, offsets = 0, []
    for k, t in sorted((r["range"], r["t"]) for r in ranged.groupBy("range").agg(F.sum("n").alias("t")).collect()):
        offsets.append((k, base))
        base += t
    return ranged, ranged.sparkSession.createDataFrame(offsets, "range int, base long")


def pack(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves.

    Every row of `docs` is a document, also one that repeats an id or has none; null or empty texts are
    the end id alone.  Rows follow the Hilbert key, then doc_id, then their place in the input; each
    sequence of `length` is full but the last.  ids are little-endian 32-bit integers.  Columns other than
    doc_id and text are not read.
    """
    id_type, kind = docs.schema["doc_id"].dataType.simpleString(), _id_type(path)
    with temporary() as keep:
        table = materialize(tokenised(docs, path).withColumn("row", F.monotonically_increasing_id()), "tokens")
        ranged, bases = along_curve(table)
        keep(ranged)
    rows = ranged.join(F.broadcast(bases), "range").select("doc_id", "ids", (F.col("base") + F.col("run")).alias("at"))  # a row a range

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            out: list[list] = [[] for _ in range(8)]
            for doc, raw, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = np.frombuffer(raw, kind).astype("<u4").tobytes()
                total, start = len(ids) // 4, 0
                while start < total:
                    offset = (first + start) % length
                    size = min(length - offset, total - start)
                    piece = ids[4 * start : 4 * (start + size)]
                    for column, value in zip(out, (doc, start, size, zlib.crc32(piece), total, (first + start) // length, offset, piece if with_ids else None), strict=True):
                        column.append(value)
                    start += size
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.column(0).type), *(pa.array(c, pa.int64()) for c in out[1:7]), pa.array(out[7], pa.binary())], ["doc_id", *_LONGS, "ids"])

    return rows.mapInArrow(cut, f"doc_id {id_type}, {', '.join(f'{c} long' for c in _LONGS)}, ids binary")


_LONGS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
