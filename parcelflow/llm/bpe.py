"""Byte-level BPE in numpy: length-bucketed padded matrices whose rows merge one pair a round."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small, text_of
from .kernel import HashIndex, PieceEncoder, U, classes, runs_of, worker_cache

#: Pieces of more bytes are matrices of one row, which merges all places of its least pair in a round.
ROW_BYTES = 512
#: Cells of one matrix.
CELLS = 1 << 20
_NONE = np.int32(0x7FFFFFFF)


class Merges:
    """Ranks of a tiktoken file, and the rank of each pair of tokens whose bytes join to a token."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, f.read().split(b"\n")))}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append((a << 32 | b) + 1)
                    values.append(rank)
        self.pairs = HashIndex(20)
        self.pairs.add(np.array(keys, U), np.array(values, np.int32))
        self.decimal = [b"%d" % i for i in range(len(self.tokens))]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where it doesn't merge or one side is padding."""
        out = np.full(a.shape, _NONE, np.int32)
        real = (a >= 0) & (b >= 0)
        got = self.pairs.get(((a[real].astype(U) << U(32)) | b[real].astype(U)) + U(1))
        out[real] = np.where(got < 0, _NONE, got)
        return out

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        width = max(map(len, pieces))
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.where(np.arange(width) < length[:, None], self.byte[flat], -1)
        rank = self.rank(ids[:, :-1], ids[:, 1:])
        out: list[np.ndarray] = [ids[0]] * len(pieces)
        row = np.arange(len(pieces))
        while len(row):
            if ids.shape[1] > 1:
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(row)), at]
            else:
                at, best = np.zeros(len(row), np.int64), np.full(len(row), _NONE)
            on = best != _NONE
            for k in np.flatnonzero(~on):
                out[row[k]] = ids[k, : length[k]]
            row, length, ids, rank, at, best = row[on], length[on] - 1, ids[on], rank[on], at[on], best[on]
            if not len(row):
                break
            here = np.arange(len(row))
            ids[here, at] = best
            column = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)  # the column behind the merge goes
            column = np.arange(ids.shape[1] - 1)
            rank = np.take_along_axis(rank, column + (column >= at[:, None]), 1) if len(column) else rank[:, :0]
            for side in (at - 1, at):
                ok = (side >= 0) & (side < ids.shape[1] - 1)
                r, c = here[ok], side[ok]
                if len(r):
                    rank[r, c] = self.rank(ids[r, c], ids[r, c + 1])
        return out

    def _row(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a round merges every place of the minimum-rank pair, from the
        left, up to the first whose merge makes a pair of lower rank, which must come next."""
        ids = self.byte[np.frombuffer(piece, np.uint8)]
        rank = self.rank(ids[:-1], ids[1:])
        while len(rank) and (best := rank.min()) != _NONE:
            at = np.flatnonzero(rank == best)
            n = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.append(True, np.diff(at) != 1), n, 0))
            at = at[(n - run) % 2 == 0]  # of places that share a token the left one
            left, right = np.where(at > 0, ids[at - 1], -1), np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            left[1:][np.diff(at) == 2] = best
            merged = np.full(len(at), best)
            lower = np.flatnonzero((self.rank(left, merged) < best) | (self.rank(merged, right) < best))
            at = at[: lower[0] + 1] if len(lower) else at
            ids[at] = best
            ids, rank = np.delete(ids, at + 1), np.delete(rank, at)
            new = at - np.arange(len(at))
            for side in (new - 1, new):
                side = side[(side >= 0) & (side < len(rank))]
                rank[side] = self.rank(ids[side], ids[side + 1])
        return ids

    def encode_pieces(self, texts: list[str]) -> list[np.ndarray]:
        """ids of pieces that the pattern has cut."""
        pieces = [t.encode("utf-8", "surrogatepass") for t in texts]
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(p) > ROW_BYTES:
                out[i] = self._row(p)
            else:
                buckets.setdefault(-(-len(p) // 4) if len(p) <= 16 else 16 + len(p).bit_length(), []).append(i)
        for rows in buckets.values():
            step = max(1, CELLS // max(len(pieces[i]) for i in rows))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def merges(path: str) -> Merges:
    return worker_cache(("merges", path), lambda: Merges(path))


def encoder(path: str, kinds: tuple) -> PieceEncoder:
    def ids_of(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = merges(path).encode_pieces(pieces)
        return np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))

    return worker_cache(("encoder", path), lambda: PieceEncoder(ids_of, np.repeat(kinds[1], kinds[0])))


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Character classes of the library's own regex engine, probed once by the driver: text that a pattern leaves out makes no tokens."""
    import tiktoken

    def members(regex: str, text: str) -> str:
        only = tiktoken.Encoding("kinds", pat_str=regex + "+", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        return only.decode_bytes(only.encode_ordinary(text)).decode()

    return worker_cache("regex kinds", lambda: runs_of(classes(members)))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): token ids of each whole text (null: empty) as little-endian 32-bit integers."""
    id_type, kinds = docs.schema["doc_id"].dataType.simpleString(), _kinds()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ids = [x.astype("<u4").tobytes() for x in encoder(path, kinds)(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(work, f"doc_id {id_type}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) of a frame that `encode` made."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            out = [merges(path).decode(np.frombuffer(x, "<u4")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(work, f"doc_id {id_type}, bytes binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each whole text encoded, and its ids decoded again.

    Every row is answered alone, so ties, repeated rows and null ids need no rule; null or empty texts
    have no ids.  Text and ids never leave the Arrow batch.
    """
    id_type, kinds = docs.schema["doc_id"].dataType.simpleString(), _kinds()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, enc = merges(path), encoder(path, kinds)
        for b in small(batches):
            n, ids_sha, text_sha = [], [], []
            for ids in enc(b.column(1).to_pylist()):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b",".join(map(m.decimal.__getitem__, ids.tolist()))).hexdigest())
                text_sha.append(hashlib.sha256(m.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(work, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
