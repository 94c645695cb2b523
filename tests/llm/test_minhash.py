import random
import re

import numpy as np
import pytest

from tidemark.llm import minhash
from tidemark.llm.components import components
from tidemark.llm.minhash import band_keys, keep_first, min_max, near_duplicates, signature_bits


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        component = least.get(root(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=repr)


def found(docs):
    return sorted(map(tuple, near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def edited(rng, words, n):
    own = list(words)
    for _ in range(n):
        own[rng.randrange(len(own))] = "e%d" % rng.randrange(10 ** 6)
    return own


def test_against_brute_force(make_docs, prose, long_text):
    texts = prose(250, seed=5)
    rows = list(enumerate(texts)) + [(None, "one two three four five six"), (None, "ONE two three four five six"),
                                     (7, texts[0]), (7, "another text with some more words in it"), (1000, long_text),
                                     (1001, long_text + " end")]
    assert found(make_docs(rows, ["key", "root", "bands", "n_shingles", "kept"])) == brute(rows)


def test_large_groups_of_near_copies(make_docs):
    """Chains and stars larger than a bucket that is compared within, and texts that share a passage only."""
    rng = random.Random(2)
    rows, base = [], ["b%d" % i for i in range(300)]
    for i in range(60):
        rows.append((100 + i, " ".join(edited(rng, base, rng.randint(0, 6)))))
    chain = ["c%d" % i for i in range(200)]
    for i in range(25):
        chain = edited(rng, chain, 2)
        rows.append((300 + i, " ".join(chain)))
    passage = ["p%d" % i for i in range(60)]
    for i in range(40):
        rows.append((400 + i, " ".join(passage + ["q%d" % rng.randrange(10 ** 6) for _ in range(rng.randint(5, 60))])))
    rng.shuffle(rows)
    assert found(make_docs(rows)) == brute(rows)


def test_one_document_of_each_group_stays(make_docs):
    copy = "the same eight words in every single copy"
    rows = [(3, copy), (1, copy), (1, copy), (2, copy.upper()), (None, copy), (9, None), (9, None), (8, ""), (None, "x y"), (None, "x y")]
    docs = make_docs(rows, ["_id", "row", "text_hash"])
    left = keep_first(docs)
    assert left.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=repr) == sorted(
        [(1, copy), (9, None), (8, ""), (None, "x y")], key=repr)


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).collect() == [] and keep_first(make_docs([])).collect() == []
    assert found(make_docs([(1, None)])) == [(1, 0, 1, True)]


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(4)
    for similarity in (0.5, 0.85):
        n, agree, bands, bits = 400, [], 0, []
        shared = int(2 * n * similarity / (1 + similarity))
        for _ in range(60):
            all_ = rng.integers(0, 2 ** 63, 2 * n - shared, dtype=np.uint64)
            a, b = np.sort(all_[:n]), np.sort(np.concatenate((all_[:shared], all_[n:])))
            s = min_max(np.concatenate((a, b)), np.array([0, n, 2 * n]))
            agree.append((s[:, 0] == s[:, 1]).mean())
            keys = band_keys(s)
            bands += bool((keys[:, 0] == keys[:, 1]).any())
            packed = signature_bits(s)
            bits.append(sum(bin(int(x) ^ int(y)).count("1") for x, y in packed))
        assert abs(np.mean(agree) - similarity) < 0.03
        assert abs(np.mean(bits) - 96 * (1 - similarity)) < 6
        if similarity == 0.85:
            # Lower variance than 96 independent values would have, and no pair is missed.
            assert bands == 60 and np.std(agree) < 1.25 * np.sqrt(0.85 * 0.15 / 96)


@pytest.mark.parametrize("n, m", [(200, 150), (50, 400), (30, 0)])
def test_components_of_random_links(spark, n, m):
    rng = random.Random(n)
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {i: root(i) for i in parent if root(i) != i}


def test_many_texts_with_a_common_passage(make_docs, monkeypatch):
    """Large buckets of small components, compared by blocks: no link is lost, and texts with much of their own drop out."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(6)
    passage = ["p%d" % i for i in range(80)]
    rows = []
    for i in range(120):
        own = ["q%d" % rng.randrange(10 ** 6) for _ in range(rng.choice([4, 6, 30]))]
        rows.append((i, " ".join(edited(rng, passage, rng.choice([0, 1, 2])) + own)))
        if rng.random() < 0.2:
            rows.append((1_000 + i, " ".join(edited(rng, rows[-1][1].split(), 1))))
    assert found(make_docs(rows)) == brute(rows)


def test_thresholds_that_the_bands_do_not_cover_are_refused(make_docs):
    for percent in (50, 79, 101):
        with pytest.raises(ValueError, match="percent"):
            near_duplicates(make_docs([]), percent)
    assert minhash.most_different(80, 96) == 50 and minhash.most_different(100) == 1
