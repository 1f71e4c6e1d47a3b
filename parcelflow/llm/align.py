"""Cross-tokenizer alignment: how the tokens of two vocabularies lie over each other, in every text and corpus-wide.

The corpus is shuffled by full text, so each distinct text is tokenised and aligned once; its pair
counts are weighted by how often the text stands in the corpus, and its measures are joined to all
doc_ids that hold it.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small, temporary, text_of
from .kernel import PieceEncoder, worker_cache
from .pack import _kinds

#: Pair counts that are sent to every task: the most frequent ones, 17 bytes each.  Others are joined.
HEAD = 400_000
#: Links that a task counts up before it hands on their sums.
PENDING = 1 << 21
#: What the piece vocabulary writes for a blank, and the most digits of an id.
MARK, WIDTH = "\u2581", 9


class Vocabularies:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, path_a: str, path_b: str, kinds: tuple) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path_a)
        t.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)

        def ids_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            got = t.encode(words, is_pretokenized=True, add_special_tokens=False)
            return np.array(got.ids, np.int32), np.bincount(np.array(got.word_ids, np.int64), minlength=len(words))

        self.encode_a = PieceEncoder(ids_of, np.repeat(kinds[1], kinds[0]))
        letters = _byte_letters()
        words = [""] * (max(t.get_vocab().values(), default=-1) + 1)
        for word, i in t.get_vocab().items():
            words[i] = word
        self.a = Tokens([bytes(letters[c] for c in w) if all(c in letters for c in w) else w.encode() for w in words])
        self.b = Tokens([self._bytes_of(i) for i in range(self.pieces.get_piece_size())])

    def _bytes_of(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(MARK, " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """ids of both for each text; none for texts that are empty or whose bytes either does not give back."""
        a = self.encode_a([" " + t for t in texts])
        b = [np.array(x, np.int32) for x in self.pieces.encode(texts, num_threads=1)]
        want = [b" " + t.encode("utf-8", "surrogatepass") for t in texts]
        good = self.a.spell(a, want) & self.b.spell(b, want)
        none = np.zeros(0, np.int32)
        for k in np.flatnonzero(~good | np.array([not t for t in texts], bool)):
            a[k] = b[k] = none
        return a, b


class Tokens:
    """The bytes and the decimal name of each id of a vocabulary, laid out for whole arrays of ids."""

    def __init__(self, entries: list[bytes]) -> None:
        self.size = np.array([len(x) for x in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        names = [str(i).encode() for i in range(len(entries))]
        self.digits = np.array([len(x) for x in names], np.int64)
        self.name = np.frombuffer(b"".join(x.ljust(WIDTH) for x in names), np.uint8).reshape(-1, WIDTH)

    def spell(self, ids: list[np.ndarray], want: list[bytes]) -> np.ndarray:
        """Whether the ids of each text stand for its bytes."""
        flat = np.concatenate([np.zeros(0, np.int32), *ids])
        owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        length = np.array([len(w) for w in want], np.int64)
        ok = np.bincount(owner, self.size[flat], len(ids)).astype(np.int64) == length
        flat = flat[ok[owner]]
        size = self.size[flat]
        spelt = self.flat[np.repeat(self.start[flat] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        text = np.frombuffer(b"".join(w for w, good in zip(want, ok.tolist(), strict=True) if good), np.uint8)
        first = np.cumsum(length[ok]) - length[ok]
        if len(first):
            ok[ok] = np.logical_and.reduceat(spelt == text, first)  # no text is without bytes: each has its blank
        return ok


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def vocabularies(path_a: str, path_b: str, kinds: tuple) -> Vocabularies:
    return worker_cache(("align", path_a, path_b), lambda: Vocabularies(path_a, path_b, kinds))


class Alignment:
    """Links and groups of a batch of texts, from the ends of their tokens; every text has its own stretch of bytes."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], of_a: Tokens, of_b: Tokens) -> None:
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int32), *side]) for side in (a, b))
        end_a, end_b = np.cumsum(of_a.size[self.a]), np.cumsum(of_b.size[self.b])  # both sides of a text are equally long
        ends_a, ends_b = (np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, bool) for _ in range(2))
        ends_a[end_a], ends_b[end_b] = True, True
        # between two neighbouring ends lies the common stretch of exactly one pair
        ends = np.flatnonzero(ends_a | ends_b)
        self.link_a, self.link_b = (np.cumsum(e)[ends] - e[ends] for e in (ends_a, ends_b))
        owner = np.repeat(np.arange(len(a)), self.n_a)
        self.text = owner[self.link_a]
        self.last_a, self.last_b = ends_b[end_a], ends_a[end_b]
        self.n_links = np.bincount(self.text, minlength=len(a))
        self.n_groups = np.bincount(owner[self.last_a], minlength=len(a))

    def keys(self) -> np.ndarray:
        """The pair of ids of each link, as one number."""
        return self.a[self.link_a].astype(np.int64) << 32 | self.b[self.link_b]

    def groups(self, of_a: Tokens, of_b: Tokens) -> Iterator[bytes]:
        """`a1,a2|b1;a3|b2,b3` for each text, in bytes."""
        n_a, n_b = len(self.a), len(self.b)
        first_a, first_b = (np.append(0, np.flatnonzero(last) + 1) for last in (self.last_a, self.last_b))
        # the A tokens of a group stand behind the B tokens of those before it, its B tokens behind its own A tokens
        place = np.concatenate([np.arange(n_a) + first_b[np.cumsum(self.last_a) - self.last_a], np.arange(n_b) + first_a[np.cumsum(self.last_b) - self.last_b + 1]]) if n_a else np.zeros(0, np.int64)
        order = np.empty(n_a + n_b, np.int64)
        order[place] = np.arange(n_a + n_b)
        name, digits = np.concatenate([of_a.name[self.a], of_b.name[self.b]]), np.concatenate([of_a.digits[self.a], of_b.digits[self.b]])
        sign = np.frombuffer(b",|,;", np.uint8)[np.concatenate([self.last_a.astype(np.int64), self.last_b + np.int64(2)])]
        name, digits = name[order], digits[order]
        end = np.cumsum(digits + 1)
        out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
        for k in range(WIDTH):
            has = digits > k
            out[(end - digits - 1 + k)[has]] = name[has, k]
        out[end - 1] = sign[order]
        cuts = np.append(0, end)[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        raw = out.tobytes()
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield raw[lo : hi - 1] if hi > lo else b""


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text, times): the corpus shuffled by full text; copies are counted up before they move."""
    return docs.select(text_of().alias("text")).groupBy("text").agg(F.count("*").alias("times"))


def _name(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def tokenised(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(name, times, a, b, n_groups, n_links, groups): ids of each distinct text, packed, and how they group.

    name is the SHA-256 of the text, by which measures find their doc_ids; groups writes the groups down as text.
    """
    kinds = _kinds()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(path_a, path_b, kinds)
        for b in small(batches):
            texts = b.column(1).to_pylist()
            ids = v.encode(texts)
            got = Alignment(*ids, v.a, v.b)
            sha = [hashlib.sha256(g).hexdigest() if g else "" for g in got.groups(v.a, v.b)]
            packed = [pa.array([x.astype(_kind(of)).tobytes() for x in side], pa.binary()) for side, of in zip(ids, (v.a, v.b), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *packed, *map(pa.array, (got.n_a, got.n_b, got.n_groups, got.n_links, sha))], ["name", "times", "a", "b", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])

    return texts.select(_name(F.col("text")).alias("name"), "text", "times").mapInArrow(work, "name binary, times long, a binary, b binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")


def _links(path_a: str, path_b: str, kinds: tuple, a: pa.Array, b: pa.Array) -> Alignment:
    v = vocabularies(path_a, path_b, kinds)
    ids = ([np.frombuffer(x, _kind(of)).astype(np.int32) for x in side.to_pylist()] for side, of in ((a, v.a), (b, v.b)))
    return Alignment(*ids, v.a, v.b)


def _kind(of: Tokens) -> str:
    return "<u4" if len(of.size) > 1 << 16 else "<u2"


def pair_counts(table: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(pair, b, count, best): how many links of the corpus hold two ids linked, and whether it is the most for its B id."""
    kinds = _kinds()

    def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key, inverse = np.unique(keys, return_inverse=True)
        out = np.zeros(len(key), np.int64)
        np.add.at(out, inverse, counts)
        return key, out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        pending = 0

        def out() -> pa.RecordBatch:
            keys, counts = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "c"])

        for batch in batches:
            for b in small(iter([batch])):
                got = _links(path_a, path_b, kinds, b.column(1), b.column(2))
                held.append(summed(got.keys(), b.column(0).to_numpy()[got.text]))
                pending += len(held[-1][0])
                if pending > PENDING:
                    yield out()
                    pending = 0
        if held:
            yield out()

    counts = table.where("n_links > 0").select("times", "a", "b").mapInArrow(work, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("count"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return materialize(counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")


def _head(pairs: DataFrame) -> tuple[int, pd.DataFrame]:
    """A count, and all pairs with at least that count: at most HEAD of them, whatever the corpus."""
    bins = sorted(((r["k"], r["c"]) for r in pairs.groupBy(F.floor(F.log2("count")).cast("int").alias("k")).agg(F.count("*").alias("c")).collect()), reverse=True)
    least, held = 1 << 62, 0
    for k, c in bins:
        held += c
        if held > HEAD:
            break
        least = 1 << k
    return least, pairs.where(F.col("count") >= least).toPandas().sort_values("pair")


def measures(table: DataFrame, pairs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(name, n_best, count_sum) of each distinct text that has links.

    The counts of the most frequent pairs go to every task, a bounded number of them; links of other pairs
    are counted up per text and joined.
    """
    kinds, spark = _kinds(), table.sparkSession
    least, head = _head(pairs)
    sent = spark.sparkContext.broadcast((head["pair"].to_numpy(np.int64), head["count"].to_numpy(np.int64), head["best"].to_numpy(bool)))

    def look(got: Alignment) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        pair, count, best = sent.value
        keys, link = np.unique(got.keys(), return_inverse=True)
        at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
        hit = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
        return keys[link], hit[link], np.where(hit, count[at] if len(pair) else 0, 0)[link], np.where(hit, best[at] if len(pair) else False, False)[link]

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            got = _links(path_a, path_b, kinds, b.column(1), b.column(2))
            _, _, count, best = look(got)
            totals = [np.zeros(b.num_rows, np.int64) for _ in range(2)]
            for total, values in zip(totals, (best.astype(np.int64), count), strict=True):
                np.add.at(total, got.text, values)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, totals)], ["name", "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            got = _links(path_a, path_b, kinds, b.column(1), b.column(2))
            keys, hit, _, _ = look(got)
            order = np.lexsort((keys[~hit], got.text[~hit]))
            key, text = keys[~hit][order], got.text[~hit][order]
            new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))[: len(key)])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text[new])), pa.array(key[new]), pa.array(np.diff(np.append(new, len(key))))], ["name", "pair", "c"])

    rows = table.where("n_links > 0").select("name", "a", "b")
    parts = [rows.mapInArrow(common, "name binary, n_best long, count_sum long")]
    others = pairs.where(F.col("count") < least)
    if not others.isEmpty():
        found = rows.mapInArrow(rare, "name binary, pair long, c long").join(others, "pair")
        parts.append(found.groupBy("name").agg(F.sum(F.when(F.col("best"), F.col("c")).otherwise(0)).alias("n_best"), F.sum(F.col("c") * F.col("count")).alias("count_sum")))
    return reduce(DataFrame.unionByName, parts).groupBy("name").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per row of `docs`.

    A is a byte-level vocabulary of the tokenizers library and reads a blank and the text; B is a
    sentencepiece model, which adds that blank itself.  Null and empty texts, and texts whose bytes A or B
    do not give back, have no tokens: zeros and ''.  Tokens link where their bytes overlap; groups end
    where tokens of both end.  A pair's count is taken over all rows, copies included; n_best counts links
    whose pair is the most frequent of its B id, ties included.  Rows that repeat a doc_id, or have none,
    are texts like others.  An empty table gives no rows; other columns are not read.
    """
    with temporary() as keep:
        table = materialize(tokenised(distinct_texts(docs), path_a, path_b), "aligned")
        pairs = pair_counts(table, path_a, path_b)
        more = measures(table, pairs, path_a, path_b).withColumnRenamed("name", "m")
        named = materialize(table.select("name", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(more, F.col("name") == F.col("m"), "left"), "measures")
        named = named.select("name", "n_a", "n_b", "n_groups", "n_links", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
        out = docs.select("doc_id", _name(text_of()).alias("name")).join(named, "name").drop("name")
        return keep(materialize(out, "alignment"))
