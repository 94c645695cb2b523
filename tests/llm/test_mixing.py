import itertools
import random
from collections import Counter, defaultdict

import pytest

from tidemark.llm import mixing
from tidemark.llm.mixing import fit_budget, mix


def brute_targets(sizes, weights=(3, 1, 2)):
    """Share by weight; whoever is above twice its size is set there and the excess is shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full, rest = {}, set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        left = rest - sum(2.0 * sizes[s] for s in full)
        for s in open_:
            target[s] = left * weight[s] / sum(weight[o] for o in open_)
        above = [s for s in open_ if target[s] > 2.0 * sizes[s]]
        if not above:
            return target
        for s in above:
            full.add(s)
            target[s] = 2.0 * sizes[s]


def check(rows, docs):
    got = mix(docs)
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    got = got.collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((i, s, len((t or "").split())) for i, t, s in rows)
    targets, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-6)
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[r.source] += r.taken
    longest = defaultdict(int)
    for r in got:
        longest[r.source] = max(longest[r.source], r["size"])
    for s in sizes:
        assert 0 <= round(targets[s]) - taken[s] <= longest[s]
    return got


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("slice_rows", [50_000, 20])
def test_targets_and_taken_words(make_docs, monkeypatch, seed, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    rng = random.Random(seed)
    sources = ["b", "a", "ä", "Z", "", None, "n", "one"]
    shares = [300, 200, 20, 100, 50, 60, 5, 1]
    rows = []
    for source, n in zip(sources, shares):
        for _ in range(n):
            rows.append((len(rows), " ".join("w" for _ in range(rng.choice([0, 1, 2, 3, 7, 7, 7, 50]))), source))
    rows += [(None, "a b c", "a"), (3, "a b c", "b"), (3, "a b c", "b"), (5, None, "a"), (6, None, None)]
    docs = make_docs(rows, ["size", "target", "draw", "row"])
    first = check(rows, docs)
    again = mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))


def test_empty_and_wordless(make_docs):
    assert mix(make_docs([])).collect() == []
    got = mix(make_docs([(1, None, "a"), (2, " ", "b")])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_budget_against_all_subsets():
    rng = random.Random(4)
    for _ in range(200):
        classes = [(length, rng.randint(1, 3)) for length in rng.sample(range(1, 40), rng.randint(1, 4))]
        reachable = {0}
        for length, n in classes:
            reachable = {s + k * length for s in reachable for k in range(n + 1)}
        budget = rng.randint(0, sum(length * n for length, n in classes))
        taken = fit_budget(budget, classes)
        assert all(0 <= taken.get(length, 0) <= n for length, n in classes)
        total = sum(length * n for length, n in taken.items())
        assert total <= budget and budget - total <= max(length for length, _ in classes)
        if budget <= 4 * max(length for length, _ in classes) and all(n * budget < sum(a * b for a, b in classes) for _, n in classes):
            assert total == max(s for s in reachable if s <= budget)
    assert fit_budget(10, []) == {} and fit_budget(7, [(0, 5), (3, 2)]) == {3: 2}


def test_large_budgets_are_met():
    rng = random.Random(9)
    classes = [(length, rng.randint(1, 400)) for length in range(1, 3_000, 7)]
    whole = sum(length * n for length, n in classes)
    for budget in (whole // 3, whole // 2 + 1, whole - 5):
        taken = fit_budget(budget, classes)
        assert 0 <= budget - sum(length * n for length, n in taken.items()) <= 5
    assert list(itertools.chain(fit_budget(0, classes).values())).count(0) == len(classes)
