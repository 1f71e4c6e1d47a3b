"""Personal data: patterns for what is direct, corpus co-occurrence for what reveals it.

Following information-theoretic sanitisation (Sanchez and Batet), a term discloses a protected entity
as far as their pointwise mutual information reaches the information content of the entity.  In the
documents that hold the entity, terms whose share passes a threshold are generalised at all their
places, or removed where the entity is certain.  All stages are SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, maybe_broadcast, numbered, temporary, text_of
from .spans import labelled, replaced, with_spans

#: Shares of an entity's information from which a term is generalised or removed, and documents that must show
#: both: one document alone is no estimate.  What generalises a term tells less than it, and at least LEAST.
GENERALISE, REMOVE, LEAST, SUPPORT = 0.85, 0.999, 0.5, 2
#: Copies are no evidence either.  A term counts if two documents have it first after different words, or, where
#: documents of the entity share less than ALIKE of their runs of GRAM words, in different passages of AROUND
#: words on both sides.  What they share is told from the SKETCH smallest hashes of each.
ALIKE, GRAM, AROUND, SKETCH = 0.5, 3, 8, 32
#: A term is generalised by one that covers so much of its documents.
COVERS = 0.8
KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, so written that no start is tried twice within a run: possessive where what follows
#: cannot be part of the run, and cards only as whole chains of 13 to 19 digits.
_LOCAL = "[A-Za-z0-9._%+-]"
_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{M}]{3,}+"


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.regexp_replace(value, "[ -]", ""))
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: (F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)))
    return F.aggregate(F.transform(each, lambda d: F.when(d > 9, d - 9).otherwise(d)), F.lit(0), lambda a, d: a + d) % 10 == 0


VALID = {
    "email": None,
    "ip": lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": _luhn,
    "phone": lambda v: F.length(F.regexp_replace(v, "[^0-9]", "")).between(9, 15),
}
HINT = {"email": "@", "phone": "+"}


def base_spans(docs: DataFrame) -> DataFrame:
    """`docs` with one column of spans for each kind; needs a column `body` without nulls."""
    for kind in KINDS:
        where = F.contains("body", F.lit(HINT[kind])) if kind in HINT else None
        docs = with_spans(docs, kind, "body", PATTERNS[kind], VALID[kind], where)
    return docs


def _entities(based: DataFrame) -> DataFrame:
    """(row, entity): each base match of a row once, as kind:value in lower case."""
    tagged = lambda kind: F.transform(kind, lambda s: F.concat(F.lit(f"{kind}:"), F.lower(s["value"])))
    return based.select("row", F.explode(F.array_distinct(F.flatten(F.array(*map(tagged, KINDS))))).alias("entity"))


def _free(words: Column) -> Column:
    """Spans that no base span overlaps."""
    base = F.flatten(F.array(*(F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in KINDS)))
    return F.filter(words, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))


def _worded(rows: DataFrame) -> DataFrame:
    """`rows` with `words`: the terms in order, in lower case, but for those inside a base span."""
    words = with_spans(rows, "words", "body", TERM)
    return words.withColumn("words", F.transform(_free(F.col("words")), lambda w: F.lower(w["value"])))


def _alike(worded: DataFrame, held: DataFrame) -> DataFrame:
    """(entity, alike): the share of its runs of words that a document of an entity has in common with another one, on average."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (GRAM - 1))), lambda i: F.xxhash64(F.slice("words", i, F.lit(GRAM))))
    sketch = F.slice(F.array_sort(F.array_distinct(runs)), 1, SKETCH)
    rows = worded.where(F.size("words") > 0).select("row", F.explode(sketch).alias("run")).join(held, "row")
    c = F.col("c")
    times = rows.groupBy("entity", "n_entity", "run").agg(F.count("*").alias("c"))
    return times.groupBy("entity").agg((F.sum(c * (c - 1)) / (F.max(F.col("n_entity")) - 1) / F.sum(c)).alias("alike"))


def disclosures(bodies: DataFrame, based: DataFrame) -> DataFrame:
    """(row, terms): for rows that hold an entity, the terms that disclose it, each with what stands for it.

    Every row of `bodies` is a document; counts cover all of them: n(entity), n(term) and n(term, entity)
    are numbers of documents.  A share of at least s asks for n(term) <= n(term, entity) * (n / n(entity)) ** (1 - s)
    and n(term, entity) is at most n(entity), so terms that are too frequent for every entity of a row are
    left out before pairs are made; that loses nothing.  Entities of the same documents are one, so a text
    with many addresses that stand together makes its terms' pairs once.  A term is generalised by the most
    telling term of the entity that discloses too little, if that is in more documents and surely in COVERS
    of the term's own; `put` is empty where a term is removed, and the mark [TERM] where no term covers it.
    """
    total = bodies.count()
    every = _entities(based)
    x = [F.bit_xor(F.xxhash64("row", F.lit(k))) for k in (1, 2)]
    n_entity = every.groupBy("entity").agg(F.count("*").alias("n_entity"), x[0].alias("x1"), x[1].alias("x2")).where((F.col("n_entity") >= SUPPORT) & (F.col("n_entity") < total))
    n_entity = materialize(n_entity.groupBy("n_entity", "x1", "x2").agg(F.min("entity").alias("entity")).select("entity", "n_entity"), "entities")
    held = materialize(every.join(maybe_broadcast(n_entity, 8, F.octet_length("entity")), "entity"), "held")
    most = F.col("n_entity") * F.pow(F.lit(total) / F.col("n_entity"), F.lit(1 - LEAST))
    worded = _worded(based.join(held.groupBy("row").agg(F.max(most).alias("most")), "row"))
    alike = materialize(_alike(worded, held), "alike")
    around = lambda i: F.xxhash64(F.slice("words", F.greatest(i - (AROUND - 1), F.lit(1)), F.least(i, F.lit(AROUND))), F.slice("words", i + 2, F.lit(AROUND)))
    each = F.transform("words", lambda w, i: F.struct(w.alias("term"), i.alias("at"), F.xxhash64(F.when(i > 0, F.get("words", i - 1))).alias("before"), around(i).alias("around")))
    words = worded.select("row", "most", F.explode(each).alias("w")).groupBy("row", "most", F.col("w.term").alias("term"))
    words = materialize(words.agg(F.min_by(F.struct("w.before", "w.around"), "w.at").alias("first")), "words")
    spread = bodies.select(F.explode(F.array_distinct(F.split(F.lower("body"), r"[^\p{L}\p{M}]+"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    near = words.groupBy("term").agg(F.count("*").alias("c"), F.max("most").alias("m")).where(F.col("c") >= SUPPORT)
    spread = materialize(near.join(spread, "term").where("n_term <= m").select("term", "n_term"), "spread")
    words = words.join(spread, "term").where("n_term <= most").select("row", "term", "n_term", "first.before", "first.around")
    pairs = materialize(words.join(held, "row").where(F.col("n_term") <= most), "pairs")
    share = F.log(F.col("both") * total / (F.col("n_term") * F.col("n_entity"))) / -F.log(F.col("n_entity") / total)
    ends = [f(c).alias(f"{n}_{c}") for c in ("before", "around") for n, f in (("lo", F.min), ("hi", F.max))]
    found = pairs.groupBy("term", "entity", "n_term", "n_entity").agg(F.count("*").alias("both"), *ends).where(F.col("both") >= SUPPORT).withColumn("share", share).where(F.col("share") >= LEAST)
    found = found.join(alike, "entity", "left").where(f"lo_before < hi_before OR (lo_around < hi_around AND coalesce(alike, 0) < {ALIKE})")
    found = materialize(found.select("term", "entity", "n_term", "n_entity", "both", "share"), "shares")
    wide = (F.col("share") < GENERALISE) & (F.col("both") >= COVERS * F.col("n_entity"))
    general = found.where(wide).groupBy("entity").agg(F.max(F.struct("share", "n_term", "term", "both")).alias("g"))
    told = found.where(F.col("share") >= GENERALISE).join(general, "entity", "left")
    covers = (F.col("g.n_term") > F.col("n_term")) & (F.col("both") + F.col("g.both") - F.col("n_entity") >= COVERS * F.col("n_term"))
    put = F.when(F.col("share") >= REMOVE, F.lit("")).when(covers, F.col("g.term")).otherwise(F.lit("[TERM]"))
    told = materialize(told.select("term", "entity", put.alias("put")), "disclosing")
    size = F.octet_length("term") + F.octet_length("entity") + F.octet_length("put")
    hit = pairs.select("row", "term", "entity").join(maybe_broadcast(told, 0, size), ["term", "entity"]).groupBy("row", "term").agg(F.min("put").alias("put"))
    return hit.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "put"))).alias("told"))


def analysed(bodies: DataFrame) -> DataFrame:
    """(row, doc_id, one column of spans for each kind, terms) of (row, doc_id, body): one row per row.

    Only places and what replaces them leave this stage, not texts.
    """
    with temporary() as keep:
        based = base_spans(bodies)
        whole = materialize(based.withColumn("body", F.when(F.size(F.concat(*KINDS)) > 0, F.col("body"))), "based")
        mentioned = whole.where("body is not null")
        told = materialize(disclosures(bodies, mentioned), "told")
        rows = with_spans(mentioned.join(told, "row"), "words", "body", TERM)
        hits = F.filter(_free(F.col("words")), lambda w: F.map_contains_key("told", F.lower(w["value"])))
        terms = F.transform(hits, lambda w: F.struct(w["start"], w["end"], F.col("told")[F.lower(w["value"])].alias("put")))
        rows = materialize(rows.select("row", terms.alias("terms")), "terms")
        out = whole.drop("body").join(maybe_broadcast(rows, 8, F.octet_length(F.to_json("terms"))), "row", "left")
        out = out.withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,put:string>>")))
        return keep(materialize(out, "analysed"))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term): one row per row of `docs`.

    Null text counts as empty.  Every row is a document, also one that repeats another or has no id; an
    empty table gives no rows.  Texts of any length are read whole.  Matches of different kinds may
    overlap; terms never overlap a match.  Columns other than doc_id and text are not read.
    """
    with temporary() as keep:
        rows = keep(analysed(numbered(docs.select("doc_id", text_of().alias("body")), "row")))
    base = F.flatten(F.array(*(labelled(k, F.col(k)) for k in KINDS)))
    every = F.concat(base, labelled("term", F.col("terms")))
    return rows.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"), F.size("terms").cast("long").alias("n_term"))


def sanitised(docs: DataFrame) -> DataFrame:
    """`docs` with personal data masked by kind, disclosing terms generalised or removed, all else as it was.

    n_chars follows the new text where there is such a column.  Null texts stay null; rows that repeat an
    id are edited each by itself.
    """
    row = fresh("__pf_row", docs)
    whole = numbered(docs, row)
    rows = analysed(whole.select(F.col(row).alias("row"), "doc_id", text_of().alias("body")))
    put = lambda spans, what: F.transform(spans, lambda s: F.struct(s["start"], s["end"], what(s).alias("put")))
    mask = lambda kind: put(F.col(kind), lambda s: F.lit(f"[{kind.upper()}]"))
    every = F.concat(*map(mask, KINDS), put(F.col("terms"), lambda s: s["put"]))
    spans = fresh("__pf_spans", docs)
    table = materialize(rows.select(F.col("row").alias(row), every.alias(spans)).where(F.size(spans) > 0), "spans")
    out = whole.join(maybe_broadcast(table, 8, F.octet_length(F.to_json(spans))), row, "left")
    out = out.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(replaced(text_of(), F.col(spans))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(docs.columns)
