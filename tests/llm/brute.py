"""Plain one-machine versions of the operators, for tests on small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter


def crc_pieces(rows, ids_of, length=2048):
    """Checks the pieces of a packing against the ids of each document (one row per doc_id)."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        ids, at = ids_of[doc], 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            part = ids[at : at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            at += p["length"]
        assert at == len(ids)
    used = []
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
        used.append(at)
    assert sum(u < length for u in used) <= 1


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def near(texts, size, percent):
    """{id: (set size, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    post, links = {}, []
    for i, s in sets.items():
        for x in s:
            post.setdefault(x, []).append(i)
    seen = {(a, b) for ids in post.values() if 1 < len(ids) for a in ids for b in ids if a < b}
    for a, b in seen:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
            links.append((a, b))
    comp = components(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(v):
    total = 0
    for i, c in enumerate(reversed(re.sub(r"[ -]", "", v))):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _valid(kind, v):
    n = len(re.sub("[^0-9]", "", v))
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": kind == "card" and 13 <= n <= 19 and _luhn(v), "phone": 9 <= n <= 15}[kind]


def pii(text):
    """(counts, base spans) of a text."""
    found = {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if _valid(k, m.group())] for k, p in PII.items()}
    return [len(found[k]) for k in PII], [f"{k}:{a}:{b}" for k in PII for a, b in found[k]]


SECRETS = {
    "assign": r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def secrets(text):
    out, counts = [], []
    for k, (kind, p) in enumerate(SECRETS.items()):
        spans = [m for m in re.finditer(p, text or "") if (len(m.group(2)) >= 6 if kind == "assign" else len(m.group()) >= (20 if kind == "access" else 24))]
        counts.append(len(spans))
        out += [(m.start(), k, m.end()) for m in spans]
    names = list(SECRETS)
    return counts, [f"{names[k]}:{a}:{b}" for a, k, b in sorted(out)]


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def warc(pages):
    """{page_id: (bytes, digest, type, refers_to)} of distinct page ids."""
    first = {}
    for i, html in pages.items():
        raw = (html or "").encode()
        first[raw] = min(i, first.get(raw, i))
    out = {}
    for i, html in pages.items():
        raw = (html or "").encode()
        again = first[raw] != i
        out[i] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[raw] if again else None)
    return out


def likelihoods(texts):
    """{(word,) or (before, word): [toxic, ordinary] by all texts, less an ordinary one, less a toxic one} of (words, label) pairs, in millionths."""
    n = [Counter(), Counter()]
    for w, y in texts:
        n[y].update({(x,) for x in w} | set(zip([None, *w], w, strict=False)))
    total = [1 + sum(k for e, k in n[c].items() if len(e) == 1) for c in (0, 1)]

    def part(counts, back, errors):
        size = sum(counts)
        share, discount = [size * (1 - back), size * back], errors * math.sqrt(size * back * (1 - back) + 0.2)
        if abs(counts[1] - share[1]) <= discount:
            return back
        if counts[1] > share[1]:
            left = [max(counts[0] + discount, 0), max(counts[1] - discount, 0)]
        else:
            left = [max(counts[0] - discount, 0), max(counts[1] + discount, 0)]
        ordinary, toxic = left[0] + 0.5 * (1 - back), left[1] + 0.5 * back
        return toxic / (toxic + ordinary)

    out = {}
    for e in set(n[0]) | set(n[1]):
        out[e] = []
        for less in ((0, 0), (1, 0), (0, 1)):
            counts = lambda x: [max(n[c][x] - less[c], 0) for c in (0, 1)]  # noqa: B023, E731
            base = total[1] / sum(total)
            back, own = base, part(counts(e[-1:]), base, 3.0)
            if len(e) == 2:
                back, own = own, part(counts(e), own, 3.5)
            out[e] += [round(1e6 * math.log(own / back)), round(1e6 * math.log((1 - own) / (1 - back)))]
    return out


def _alike(docs):
    """The mean share of its runs of three words that a document has in common with another."""
    runs = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} for w in docs if w]
    times = Counter(r for own in runs for r in own)
    return sum(c * (c - 1) for c in times.values()) / (len(docs) - 1) / max(1, sum(times.values()))


def disclosing(texts, generalise=0.85, remove=0.999, least=0.5, support=2, covers=0.8):
    """{row: [(start, end, put)]} of the terms that disclose an entity of their row."""
    held, words, n_term, n_entity, first = {}, {}, Counter(), Counter(), {}
    for row, text in texts.items():
        _, spans = pii(text)
        at = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in spans)]
        held[row] = {f"{k}:{text[a:b].lower()}" for a, b, k in at}
        n_entity.update(held[row])
        n_term.update(set(re.findall(r"[^\W\d_]+", (text or "").lower())))
        found = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W\d_]{3,}", text or "")]
        words[row] = [w for w in found if not any(a < w[1] and w[0] < b for a, b, _ in at)]
        own = [w[2] for w in words[row]]
        for k, term in enumerate(own):
            first.setdefault((row, term), (own[k - 1] if k else None, (own[max(0, k - 8) : k], own[k + 1 : k + 9])))
    n, share, both_of = len(texts), {}, {}
    for entity in n_entity:
        if support <= n_entity[entity] < n:
            rows = [r for r in held if entity in held[r]]
            apart = _alike([[w[2] for w in words[r]] for r in rows]) < 0.5
            for term, both in Counter(t for r in rows for t in {w[2] for w in words[r]}).items():
                seen = [first[r, term] for r in rows if (r, term) in first]
                if both >= support and (len({b for b, _ in seen}) > 1 or (apart and any(w != seen[0][1] for _, w in seen))):
                    share[term, entity] = math.log(both * n / (n_term[term] * n_entity[entity])) / -math.log(n_entity[entity] / n)
                    both_of[term, entity] = both
    out = {}
    for row in texts:
        put = {}
        for (term, entity), s in share.items():
            if entity in held[row] and s >= generalise:
                k = n_entity[entity]
                safe = [(t, n_term[w], w, both_of[w, e]) for (w, e), t in share.items() if e == entity and least <= t < generalise and both_of[w, e] >= covers * k]
                best = max(safe, default=None)
                good = best and best[1] > n_term[term] and both_of[term, entity] + best[3] - k >= covers * n_term[term]
                new = "" if s >= remove else best[2] if good else "[TERM]"
                put[term] = min(put.get(term, new), new)
        out[row] = [(a, b, put[w]) for a, b, w in words[row] if w in put]
    return out
