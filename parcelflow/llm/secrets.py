"""Secrets by a trigram inverted index: Boolean queries derived from each regex, postings, verification."""

from __future__ import annotations

import re._constants as C
import re._parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, maybe_broadcast, numbered, text_of
from .exact import LOWER, UPPER
from .spans import SPAN, labelled, with_spans

_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: name: (pattern, check of a match).  The first three are the base; hex takes whole runs, access whole words.
RULES = {
    "assign": (_ASSIGN, lambda v: F.length(F.regexp_extract(v, _ASSIGN, 2)) >= 6),
    "access": (r"AKIA[A-Z0-9]{16,}", None),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}", None),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", None),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", None),
    "google": (r"AIza[A-Za-z0-9_-]{35}", None),
    "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", None),
    "private_key": (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", None),
}
BASE = ["assign", "access", "hex"]
#: Strings that one group of a query may stand for, and characters of a class that count as literals.
MOST, CLASS = 64, 6


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """Groups that must all hold; a group holds if all trigrams of one of its strings are in the text.

    Letters count as lower case.  An empty list means that nothing is mandatory.
    """
    groups: list[set[str]] = []

    def finite(items) -> set[str] | None:  # noqa: ANN001
        """All strings that a part of the regex matches, if they are few."""
        out = {""}
        for op, arg in items:
            if op is C.LITERAL:
                new = {chr(arg).lower()}
            elif op is C.IN and len(arg) <= CLASS and all(o is C.LITERAL for o, _ in arg):
                new = {chr(a).lower() for _, a in arg}
            elif op is C.SUBPATTERN:
                new = finite(arg[3])
            elif op is C.BRANCH:
                parts = [finite(x) for x in arg[1]]
                new = None if None in parts else set().union(*parts)
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] <= 4:
                one = finite(arg[2])
                new = None if one is None else {"".join([x] * k) for x in one for k in range(arg[0], arg[1] + 1)} if len(one) == 1 or arg[1] == 1 else None
            else:
                new = None
            if new is None or len(out) * len(new) > MOST:
                return None
            out = {a + b for a in out for b in new}
        return out

    def walk(items) -> None:  # noqa: ANN001
        held = {""}
        for item in items:
            one = finite([item])
            if one is not None and len(held) * len(one) <= MOST:
                held = {a + b for a in held for b in one}
                continue
            groups.append(held)
            held = one if one is not None else {""}
            op, arg = item
            if one is None and op is C.SUBPATTERN:
                walk(arg[3])
            elif one is None and op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
                walk(arg[2])
        groups.append(held)

    walk(P.parse(pattern))
    out = []
    for strings in groups:
        grams = [sorted({s[i : i + 3] for i in range(len(s) - 2)}) for s in sorted(strings)]
        if all(grams):
            out.append(grams)
    return out


def _any_of(grams: list[str]) -> str:
    """A regex that is empty before any of some trigrams and captures it, branching letter by letter."""
    tree: dict[str, dict[str, list[str]]] = {}
    for a, b, c in sorted(set(grams)):
        tree.setdefault(a, {}).setdefault(b, []).append(c)
    quoted = lambda chars: "[" + "".join("\\" + c if not c.isalnum() else c for c in chars) + "]"
    deep = [quoted(a) + "(?:" + "|".join(quoted(b) + quoted(cs) for b, cs in sub.items()) + ")" for a, sub in tree.items()]
    return f"(?=({'|'.join(deep)}))" + quoted(tree)


def build_index(bodies: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, row) of the trigrams that some query names, each once a row; letters A-Z count as a-z.

    One pass over each text.  The table can be written and given to `secrets` again and again.
    """
    folded = F.translate("body", UPPER, LOWER)
    return bodies.select("row", F.explode(F.array_distinct(F.regexp_extract_all(folded, F.lit(_any_of(grams)), F.lit(1)))).alias("gram"))


def named_grams(rules: dict) -> list[str]:
    """Trigrams that the queries of some rules name."""
    return sorted({gram for pattern, _ in rules.values() for strings in trigram_query(pattern) for grams in strings for gram in grams})


def candidates(index: DataFrame, queries: dict[str, list[list[list[str]]]]) -> DataFrame:
    """(row, rules): documents whose postings satisfy the query of each rule.

    Postings of a document are counted per string before they move, so a trigram of every document is
    no hot key.
    """
    terms = [(rule, g, s, gram, len(grams), len(query)) for rule, query in queries.items() for g, strings in enumerate(query) for s, grams in enumerate(strings) for gram in grams]
    table = index.sparkSession.createDataFrame(terms, "rule string, g int, s int, gram string, need int, groups int")
    hits = index.join(F.broadcast(table), "gram")  # as many rows as the rules have trigrams
    strings = hits.groupBy("row", "rule", "g", "s", "need", "groups").agg(F.count("*").alias("c")).where("c = need")
    held = strings.groupBy("row", "rule", "groups").agg(F.count_distinct("g").alias("c")).where("c = groups")
    return held.groupBy("row").agg(F.sort_array(F.collect_set("rule")).alias("rules"))


def secrets(bodies: DataFrame, rules: dict | None = None, index: DataFrame | None = None) -> DataFrame:
    """(row, doc_id, one column of spans for each rule) of (row, doc_id, body): one row per row.

    Rules with a query verify its candidates only, the others scan every text.  `index` is what
    `build_index` gave for these rows and the rules' trigrams; without it the index is built here.
    """
    rules = rules or RULES
    queries = {name: q for name, (pattern, _) in rules.items() if (q := trigram_query(pattern))}
    out = bodies
    for name, (pattern, valid) in rules.items():
        if name not in queries:
            out = with_spans(out, name, "body", pattern, valid)
    out = out.drop("body")
    if queries:
        index = materialize(build_index(bodies, named_grams(rules)), "postings") if index is None else index
        found = materialize(candidates(index, queries), "candidates")
        rows = bodies.join(maybe_broadcast(found, 64), "row")
        for name in queries:
            rows = with_spans(rows, name, "body", rules[name][0], rules[name][1], F.array_contains("rules", name))
        hit = rows.where(F.size(F.concat(*queries)) > 0).select("row", *queries)
        out = out.join(maybe_broadcast(materialize(hit, "verified"), 512), "row", "left")
        out = out.withColumns({name: F.coalesce(name, F.array().cast(SPAN)) for name in queries})
    return out.select("row", "doc_id", *rules)


def bodies_of(docs: DataFrame) -> DataFrame:
    """(doc_id, body, row) in the shared folder: null texts are empty, and rows are told apart by number."""
    return numbered(docs.select("doc_id", text_of().alias("body")), "row")


def _ordered(names: list[str]) -> Column:
    """kind:start:end of all spans by start, then by kind as listed."""
    def numbered(k: int) -> Column:
        return F.transform(names[k], lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))

    tagged = F.concat(*map(numbered, range(len(names))))
    kinds = F.array(*(F.lit(n) for n in names))
    return F.array_join(F.transform(F.array_sort(tagged), lambda s: F.concat(kinds[s["kind"]], F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): one row per row of `docs`.

    Null text counts as empty.  Every row is a document, also one that repeats another or has no id; an
    empty table gives no rows.  Texts of any length are read whole.  Matches of different rules may
    overlap and are all listed.  Columns other than doc_id and text are not read.
    """
    return secrets(bodies_of(docs)).select("doc_id", *(F.size(n).cast("long").alias(f"n_{n}") for n in BASE), F.sha2(_ordered(BASE), 256).alias("base_sha256"), _ordered(list(RULES)).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, labels): kind:start:end of each secret as an array, for callers that rewrite texts."""
    return secrets(bodies_of(docs)).select("doc_id", F.concat(*(labelled(n, F.col(n)) for n in RULES)).alias("labels"))
