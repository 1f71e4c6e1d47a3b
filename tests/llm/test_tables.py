"""Who owns working tables: stages in a chain, two threads at once, and the folder when results have been read."""

import gc
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest

import corpus_pipeline
from parcelflow.llm import common, exact, minhash


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(30)) for _ in range(60)]
    texts += texts[:10] + [t + " end" for t in texts[10:20]]
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").cache()


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_in_a_chain(spark, docs):
    """Stages that are evaluated only at the end give what they give one by one, also when read again."""
    one = corpus_pipeline.without_copies(spark, docs, "")
    two = corpus_pipeline.without_near_copies(spark, spark.createDataFrame(one.collect(), docs.schema), "")
    chained = corpus_pipeline.without_near_copies(spark, corpus_pipeline.without_copies(spark, docs, ""), "")
    gc.collect()
    spark._jvm.System.gc()
    corpus_pipeline.without_copies(spark, docs, "").count()
    assert rows(chained) == rows(two) == rows(chained) and rows(one) == rows(corpus_pipeline.without_copies(spark, docs, ""))


def test_two_threads(docs):
    want = rows(exact.drop_exact(docs)), rows(minhash.drop_near(docs))
    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(lambda f: rows(f(docs)), [exact.drop_exact, minhash.drop_near] * 2))
    assert got == [*want, *want]


def test_nothing_is_left(spark, docs):
    """Tables go when the block around them ends, or when no plan can read them any more."""
    folder = common.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with common.temporary():
        assert exact.exact_groups(docs).count() == docs.count()
        assert set(os.listdir(folder)) - before
    assert not set(os.listdir(folder)) - before
    out = exact.drop_exact(docs)
    assert out.count() == 70 and set(os.listdir(folder)) - before
    del out
    for _ in range(10):
        docs.groupBy("lang").count().collect()  # Spark holds the plan of the query before this one
        gc.collect()
        spark._jvm.System.gc()
        common.sweep()
        if not set(os.listdir(folder)) - before:
            break
    assert not set(os.listdir(folder)) - before


def test_hot_group_is_spread_and_compared(spark):
    """Half of all rows are one text, in two spellings; ids that repeat for other texts make no false difference."""
    rows = [(i, "Same Text" if i % 4 else "same text") for i in range(4000)] + [(4000 + i % 1500, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = exact.exact_groups(docs).groupBy("group_size").count().collect()
    assert sorted((r.group_size, r["count"]) for r in got) == [(1, 3000), (4000, 4000)]
    code = exact.digests(docs)
    groups = common.materialize(exact._grouped(code, "digest"), "groups")
    assert exact._differing(docs, groups, 7000).isEmpty()
    joined = exact._by_digest(code.select("digest"), groups, 7000)
    assert joined.count() == 7000 and "group_size" in joined.columns
