"""Toxicity by class-conditional models of words and bigrams that share their backoff.

An expression is a word or a bigram.  For each class it is counted in how many labelled texts it stands, over
all labelled rows outside the held-out third.  As in Kneser-Ney smoothing these are counts of contexts, not of
occurrences, and they are discounted absolutely: of what an expression has in a class beyond or below its
share by the shared backoff, a number of standard errors is taken away.  So a rare bigram has the likelihoods
of its word, and a rare word those of both classes together.  A text's score is a logistic of the difference
of its two log-likelihoods over its number of words; the scale and the offset are fitted on likelihoods that
leave the text itself out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import fresh, materialize, maybe_broadcast, numbered, small, temporary, text_of
from .kernel import HashIndex, U, mix, words

#: Scale and offset are fitted on at most so many labelled rows of each class, in the order of a hash.  Counts have no such bound.
SAMPLE_ROWS = 6000
#: Rejected from this score on.
THRESHOLD = 0.7
#: Standard errors that are discounted from words and from bigrams, and the variance that stands for a count of nothing.
WORD_DISCOUNT, PAIR_DISCOUNT, LEAST = 3.0, 3.5, 0.2
#: Texts that the shared backoff counts for besides those that hold the expression.
VIRTUAL = 0.5
#: In the fit classes weigh as their shares to this power: 1 as they are, 0 alike.
BALANCE = 0.5
#: Expressions that are sent to every task, the most frequent first; the others are joined.
SENT = 1 << 18
#: Log-likelihoods are whole numbers of this unit, so their sums don't depend on the order.
UNIT = 1e-6
_START, _WORD = U(0x53544152), U(0x574F5244)
_LOW = U(0xFFFFFFFF)
#: Expressions that a task counts before it passes them on.
_HELD = 1 << 20
#: Log-likelihoods of both classes by all counts, and without a text of the ordinary or of the toxic class.
ALL, WITHOUT = ("t", "o"), (("t0", "o0"), ("t1", "o1"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, y) outside the held-out third; an id that is labelled more than once has its largest label."""
    y = F.col("toxic").cast("int")
    rows = labels.select("doc_id", y.alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(~held_out())
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


def _expressions(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the word and of the bigram at each place, and the first place of each text.

    A key is the code of the word before, or a mark, and the code of the word.  Codes have 32 bits: they
    are statistics and need not be apart.
    """
    hashed, first = words(col)
    code = hashed >> U(32)
    before = np.append(_START, code[:-1])[: len(code)]
    before[first[:-1][np.diff(first) > 0]] = _START
    return _WORD << U(32) | code, before << U(32) | code, first


def _of_texts(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its different expressions, and how often it has each."""
    word, pair, first = _expressions(col)
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(np.concatenate([word[a:z], pair[a:z]]), return_counts=True)


def text_counts(rows: DataFrame) -> DataFrame:
    """(key, n0, n1) from (y, text): texts of each class that hold each expression, counted in tasks before they move."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            key, y = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            distinct, of = np.unique(key, return_inverse=True)
            counts = [np.bincount(of[y == c], minlength=len(distinct)).astype(np.int32) for c in (0, 1)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), *map(pa.array, counts)], ["key", "n0", "n1"])

        for b in small(batches):
            for y, (own, _) in zip(b.column(0).to_pylist(), _of_texts(b.column(1)), strict=True):
                held.append((own, np.full(len(own), y, np.int8)))
                size += len(own)
                if size >= _HELD:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    counted = rows.select("y", "text").mapInArrow(work, "key long, n0 int, n1 int")
    return counted.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _share(n0: Column, n1: Column, back: Column, errors: float) -> Column:
    """The toxic part of an expression: its counts, discounted towards what the backoff gives."""
    n = n0 + n1
    more, discount = n1 - n * back, errors * F.sqrt(n * back * (1 - back) + LEAST)
    toxic = F.greatest(n * back + more - F.signum(more) * discount, F.lit(0.0)) + VIRTUAL * back
    ordinary = F.greatest(n - n * back - more + F.signum(more) * discount, F.lit(0.0)) + VIRTUAL * (1 - back)
    return F.when(F.abs(more) <= discount, back).otherwise(toxic / (toxic + ordinary))


def likelihoods(counts: DataFrame) -> DataFrame:
    """(key, n, t, o, t0, o0, t1, o1): what an expression adds to the log-likelihoods of both classes, in UNIT.

    With r the toxic part of a word w, q that of the bigram v w and R that of all words, the class models are
        P_toxic(w | v) = P(w | v) q / R,   P_ordinary(w | v) = P(w | v) (1 - q) / (1 - R)
    and P(w | v), which both share, cancels where they are compared.  A word adds log r / R and log (1 - r) / (1 - R),
    a bigram what q has besides r.  t0, o0 and t1, o1 are the same without one text of a class that holds the
    expression.  Expressions that add nothing, because they have just their backoff, have no row.
    """
    before, word = F.shiftrightunsigned("key", 32), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))
    table = counts.select("key", word.alias("word"), (before == int(_WORD)).alias("single"), *(F.col(c).cast("double").alias(c) for c in ("n0", "n1")))
    total = table.where("single").agg(*((F.coalesce(F.sum(c), F.lit(0.0)) + 1).alias(c) for c in ("n0", "n1"))).first()
    base = F.lit(total["n1"] / (total["n0"] + total["n1"]))
    n0, n1 = F.col("n0"), F.col("n1")
    less = [(n0, n1), (F.greatest(n0 - 1, F.lit(0.0)), n1), (n0, F.greatest(n1 - 1, F.lit(0.0)))]

    def added(rows: DataFrame, back: list[Column], errors: float) -> DataFrame:
        rows = rows.withColumns({f"q{i}": _share(*less[i], back[i], errors) for i in range(3)})
        out = []
        for i, (t, o) in enumerate((ALL, *WITHOUT)):
            q = F.col(f"q{i}")
            out += [F.round(F.log(q / back[i]) / UNIT).cast("int").alias(t), F.round(F.log((1 - q) / (1 - back[i])) / UNIT).cast("int").alias(o)]
        return rows.select("key", "word", (n0 + n1).cast("long").alias("n"), *out, *(f"q{i}" for i in range(3)))

    single = added(table.where("single"), [base] * 3, WORD_DISCOUNT)
    back = [F.col(f"r{i}") for i in range(3)]
    parts = single.select("word", *(F.col(f"q{i}").alias(f"r{i}") for i in range(3)))
    double = added(table.where("NOT single").join(parts, "word"), back, PAIR_DISCOUNT)
    names = [*ALL, *WITHOUT[0], *WITHOUT[1]]
    return single.unionByName(double).where(" OR ".join(f"{c} <> 0" for c in names)).select("key", "n", *names)


@dataclass
class Model:
    """Expressions that are sent, those that are joined (none, where all could be sent), and the line of the score."""

    sent: tuple[np.ndarray, np.ndarray]
    joined: DataFrame | None
    names: tuple[str, str] = ALL
    scale: float = 0.0
    offset: float = 0.0

    @classmethod
    def of(cls, table: DataFrame, names: tuple[str, str], most: int) -> Model:
        """From a table that is written: of its most frequent expressions at most `most` are sent."""
        rows = table.where(" OR ".join(f"{c} <> 0" for c in names)).select("key", "n", *names)
        bins = rows.groupBy(F.floor(F.log2("n") * 4).alias("b")).count().orderBy(F.desc("b")).collect()  # 256 rows at most
        least, total = None, 0
        for b, n in bins:
            total += n
            if total > most:
                break
            least = b
        split = F.floor(F.log2("n") * 4) >= F.lit(least) if least is not None else F.lit(False)
        got = rows.where(split).orderBy("key").toArrow()
        sent = got["key"].to_numpy().astype(np.int64).view(U), np.stack([got[c].to_numpy().astype(np.int64) for c in names], 1)
        return cls(sent, rows.where(~split).drop("n") if total > most else None, names)

    def score(self, toxic: Column, ordinary: Column, n: Column) -> Column:
        line = self.scale * UNIT * (toxic - ordinary) / F.greatest(n, F.lit(1)) + self.offset
        return 1 / (1 + F.exp(-F.least(F.greatest(line, F.lit(-30.0)), F.lit(30.0))))


def _index(keys: np.ndarray) -> HashIndex:
    index = HashIndex(4)
    index.add(mix(keys) | U(1), np.arange(len(keys)))
    return index


def with_likelihoods(docs: DataFrame, text: str, model: Model, toxic: str, ordinary: str, n: str) -> DataFrame:
    """`docs` with three columns: the log-likelihoods of both classes in UNIT, by what both share, and the number of words."""
    new = (toxic, ordinary, n)
    sent = docs.sparkSession.sparkContext.broadcast(model.sent)  # SENT rows at most
    rows = docs if model.joined is None else numbered(docs, fresh("_row", docs))
    at = rows.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, value = _index(sent.value[0]), np.vstack([sent.value[1], np.zeros((1, 2), np.int64)])
        for b in small(batches):
            word, pair, first = _expressions(b.column(at).cast(pa.string()).fill_null(""))
            found = value[index.get(mix(word) | U(1))] + value[index.get(mix(pair) | U(1))]
            upto = np.vstack([np.zeros((1, 2), np.int64), np.cumsum(found, 0)])
            total = upto[first[1:]] - upto[first[:-1]]
            more = [pa.array(total[:, 0]), pa.array(total[:, 1]), pa.array(np.diff(first).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *new])

    schema = StructType([*rows.schema.fields, *(StructField(c, LongType()) for c in new)])
    out = rows.mapInArrow(work, schema)
    if model.joined is None:
        return out
    row, id_at = rows.columns[-1], len(rows.columns) - 1

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(sent.value[0])
        for b in small(batches):
            for r, (key, often) in zip(b.column(id_at).to_pylist(), _of_texts(b.column(at).cast(pa.string()).fill_null("")), strict=True):
                left = index.get(mix(key) | U(1)) < 0
                yield pa.RecordBatch.from_arrays([pa.array(np.full(left.sum(), r, np.int64)), pa.array(key[left].view(np.int64)), pa.array(often[left].astype(np.int64))], ["r", "key", "often"])

    # frequent expressions are sent, so no key of this join is hot
    found = rows.mapInArrow(keys, "r long, key long, often long").join(model.joined, "key")
    t, o = model.names
    rest = found.groupBy("r").agg(F.sum(F.col("often") * F.col(t)).alias("t"), F.sum(F.col("often") * F.col(o)).alias("o"))
    rest = rest.select(F.struct("r", "t", "o").alias(fresh("_rest", out)))
    own = rest.columns[0]
    both = out.join(rest, out[row] == F.col(f"{own}.r"), "left")
    sums = {c: F.col(c) + F.coalesce(F.col(f"{own}.{p}"), F.lit(0)) for c, p in ((toxic, "t"), (ordinary, "o"))}
    return both.withColumns(sums).drop(row, own)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Scale and offset by weighted logistic regression in bounded Newton steps."""
    unit = np.sqrt((x**2).mean()) + 1e-9
    x = np.stack([x / unit, np.ones(len(x))], 1)
    line = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        grad = x.T @ (w * (p - y)) + 1e-3 * line
        hess = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        step *= min(1, 5 / max(np.abs(step).max(), 1e-9))
        line -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(line[0] / unit), float(line[1])


def fit(docs: DataFrame, labels: DataFrame, most: int = SENT) -> Model:
    """The model of all labelled rows outside the held-out third; without labels of both classes it gives one score to all."""
    with temporary() as keep:
        ids = materialize(labelled(labels), "labelled")
        prior = ids.agg(F.avg(F.col("y").cast("double"))).first()[0]
        rows = docs.select("doc_id", text_of().alias("text"))
        counts = materialize(text_counts(rows.join(maybe_broadcast(ids, 24), "doc_id")), "counts")
        table = keep(materialize(likelihoods(counts), "likelihoods"))
        order = F.xxhash64(F.lit("toxicity"), "doc_id")
        x, y = [], []
        for c in (0, 1):
            sample = ids.where(F.col("y") == c).orderBy(order, "doc_id").limit(SAMPLE_ROWS).select("doc_id")
            texts = rows.join(F.broadcast(sample), "doc_id")  # SAMPLE_ROWS ids at most
            seen = with_likelihoods(texts, "text", Model.of(table, WITHOUT[c], most), "t", "o", "n")
            # rows that repeat an id count once, and in one order whatever the partitions
            got = seen.groupBy("doc_id").agg(F.min((F.col("t") - F.col("o")) / F.greatest("n", F.lit(1))).alias("x")).select("x").collect()
            x += sorted(r["x"] * UNIT for r in got)
            y += [c] * len(got)
        model = Model.of(table, ALL, most)
    x, y = np.array(x), np.array(y, float)
    if len(y) and 0 < y.mean() < 1:
        weight = np.where(y == 1, prior**BALANCE / y.mean(), (1 - prior) ** BALANCE / (1 - y.mean()))
        model.scale, model.offset = _logistic(x, y, weight * len(y) / weight.sum())
    else:  # no labels, or labels of one kind
        p = min(max(prior or 0.0, 1e-6), 1 - 1e-6)
        model.offset = float(np.log(p / (1 - p)))
    return model


def score_documents(docs: DataFrame, labels: DataFrame, most: int = SENT) -> DataFrame:
    """(doc_id, held_out, score, predicted, toxic_likelihood, ordinary_likelihood): one row per row of `docs`.

    The likelihoods are logarithms per word, by the likelihood that both classes share.  Every row is scored by
    its text alone, so ties, repeated rows and rows without id need no rule, and columns besides doc_id and text
    play no part, whatever their names; a null text counts as empty, and an empty one gets the score of no
    evidence.  An empty table gives no rows.  Ids that are labelled but not in `docs`, null labels and labels
    other than 0 and 1 are ignored.
    """
    model = fit(docs, labels, most)
    rows = with_likelihoods(docs.select("doc_id", text_of().alias("text")), "text", model, "t", "o", "n").drop("text")
    rows = rows.withColumn("score", model.score(F.col("t"), F.col("o"), F.col("n")))
    per = lambda c: F.col(c) * UNIT / F.greatest("n", F.lit(1))
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        per("t").alias("toxic_likelihood"), per("o").alias("ordinary_likelihood"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = SENT) -> DataFrame:
    """`docs` without the rows that the model rejects; all columns stay.

    Rows are judged each by its own text, so rows that repeat an id are told apart, null and empty texts have the
    score of no evidence, an empty table stays empty, and columns of any other name pass.
    """
    model = fit(docs, labels, most)
    names = [fresh(c, docs) for c in ("toxic_part", "ordinary_part", "n_words")]
    rows = with_likelihoods(docs, "text", model, *names)
    return rows.where(model.score(*map(F.col, names)) < THRESHOLD).select(*docs.columns)
