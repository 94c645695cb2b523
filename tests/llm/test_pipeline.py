import importlib
from collections import Counter

import pytest

from tidemark.llm import minhash, toxicity
from tidemark.llm.common import stage, table

corpus_pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The documents before the first and after each stage."""
    docs = [table(spark, sf, "documents")]
    for name, step in corpus_pipeline.STAGES:
        docs.append(stage(step(spark, docs[-1], sf), "test"))
    return docs


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(d.columns == steps[0].columns for d in steps[:-1])
    texts = {r.doc_id: r for r in steps[0].collect()}
    for d in steps[1:-1]:
        assert all(texts[r.doc_id] == r for r in d.collect())


def test_each_stage_does_what_its_operator_says(spark, sf, steps):
    found = toxicity.toxicity(steps[0], table(spark, sf, "labels")).where("predicted = 0")
    assert ids(steps[1]) == ids(found)
    assert ids(steps[2]) == ids(minhash.near_duplicates(steps[1], 80).where("kept"))
    from test_decontaminate import brute
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    clean = [r[0] for r in brute([(r.doc_id, r.text) for r in steps[2].collect()], items) if not r[5]]
    assert ids(steps[3]) == Counter(clean) and len(clean) < steps[2].count()
    sizes = {r.doc_id: len((r.text or "").split()) for r in steps[3].collect()}
    mixed = ids(steps[4])
    assert set(mixed) <= set(sizes) and set(mixed.values()) <= {1, 2}
    assert sum(sizes[i] * n for i, n in mixed.items()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)
    assert ids(steps[5]) == mixed and "shard" in steps[5].columns


def test_run_gives_the_last_stage(spark, sf, steps):
    key = ["doc_id", "size", "shard", "slot"]
    got = corpus_pipeline.run(spark, sf).select(*key).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, steps[-1].select(*key).collect()))


def test_near_copies_are_those_of_eight_tenths(steps):
    """The near-duplicate stage against all pairs of whole shingle sets."""
    from test_minhash import shingles
    rows = sorted((r.doc_id, r.text) for r in steps[1].select("doc_id", "text").collect())
    sets = [shingles(t) for _, t in rows]
    root, between = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            shared, every = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] and 100 * shared >= 80 * every:
                between += 100 * shared < 85 * every
                root = [root[j] if r == root[i] else r for r in root]
    first = {}
    for i, (doc, _) in enumerate(rows):
        first.setdefault(root[i] if sets[i] else ("empty", doc), doc)
    assert between and ids(steps[2]) == Counter(first.values())
