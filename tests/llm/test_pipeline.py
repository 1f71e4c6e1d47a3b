"""The corpus pipeline and each of its stages against plain versions, with odd rows in the table."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    some = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "the", "of"]) + str(rng.randint(0, 30)) for _ in range(n))
    rows, labels = [], []
    for i in range(240):
        w = some(40).split()
        for _ in range(8 * (i % 5 == 0)):
            w[rng.randrange(40)] = rng.choice(["moron", "vermin", "scum"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    base = some(60)
    rows += [(300, base), (301, base.upper()), (302, base + " tail"), (303, base + " end of it"), (303, some(30)), (None, base), (None, None), (304, ""), (305, "mail a@b.example.com or +44 20 7946 0958"), (306, "x" * 9000)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _norm(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_pipeline(spark, folder):
    docs, before, stages = spark.read.parquet(f"{folder}/documents.parquet"), [], dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "minhash_dedup", "pii", "packing"]
    for name in list(stages)[:4]:
        before = docs.collect()
        docs = stages[name](spark, docs, folder).cache()
        rows = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "toxicity":
            marked = {i for i in range(240) if i % 5 == 0}
            gone = {r.doc_id for r in before} - {r.doc_id for r in rows}
            assert gone <= marked and len(gone) > 0.8 * len(marked)
        elif name == "exact_dedup":
            best = {}
            for r in before:
                k = _norm(r.text)
                best[k] = max(best.get(k, (False, 0)), (r.doc_id is not None, r.doc_id or 0))
            assert sorted(((r.doc_id is not None, r.doc_id or 0), _norm(r.text)) for r in rows) == sorted((v, k) for k, v in best.items())
        elif name == "minhash_dedup":
            want = brute.near({i: r.text for i, r in enumerate(before)}, 5, 80)
            groups = {}
            for i, r in enumerate(before):
                groups.setdefault(want[i][1], []).append((r.doc_id is None, r.doc_id or 0, r.text or ""))
            assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows) == sorted(min(g) for g in groups.values())
        else:
            told = brute.disclosing({i: r.text for i, r in enumerate(before)})
            want = []
            for i, r in enumerate(before):
                spans = [(int(a), int(b), f"[{k.upper()}]") for k, a, b in (s.split(":") for s in brute.pii(r.text)[1])] + told[i]
                text, at = "", 0
                for a, b, put in sorted(spans):
                    if a >= at:
                        text += r.text[at:a] + put
                    at = max(at, b)
                want.append((r.doc_id or 0, text + r.text[at:] if spans else r.text or ""))
            assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted(want)
            assert all(r.n_chars == len(r.text or "") for r in rows)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = {}
    for r in docs.collect():
        whole.setdefault(r.doc_id, []).append([*t.encode(r.text or "", add_special_tokens=False).ids, 1])
    packed = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]
    once = {i: ids[0] for i, ids in whole.items() if len(ids) == 1}
    assert sum(r["length"] for r in packed) == sum(len(x) for ids in whole.values() for x in ids)
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], 0)
        by_doc[r["doc_id"]] += r["length"]
    assert all(by_doc[i] == len(ids) for i, ids in once.items())


def test_empty_tables(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
