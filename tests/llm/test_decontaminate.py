import hashlib
import random
import re

import pytest

from tidemark.llm.decontaminate import contamination, decontaminate, longest_matches


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(rows, items, width=10):
    out = []
    for doc, text in rows:
        own, hit, named = words(text), set(), set()
        for item, t in items:
            w = words(t)
            for j in range(max(1, len(w) - width + 1) if w else 0):
                window = w[j:j + width]
                for i in range(len(own) - len(window) + 1):
                    if own[i:i + len(window)] == window:
                        hit |= set(range(i, i + len(window)))
                        named.add(str(item))
        named.discard("None")
        out.append((doc, len(own), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def case(seed, n=60, vocabulary=8):
    rng = random.Random(seed)
    some = ["".join(rng.choice("abé7") for _ in range(rng.randint(1, 3))) for _ in range(vocabulary)]
    items = [(k, rng.choice(" -._").join(rng.choice(some) for _ in range(rng.choice([10, 11, 14, 30])))) for k in range(12)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(some) for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w))
            parts.append(" ".join(w[a:a + rng.randint(5, 25)]).upper())
            parts.append(" ".join("z%d" % rng.randrange(99) for _ in range(rng.randint(0, 4))))
        rows.append((i, "\n".join(parts)))
    return rows, items


@pytest.mark.parametrize("seed, short, part_bytes", [(1, [], 1 << 20), (2, [(90, "ab"), (91, "7 7 7"), (92, "")], 1 << 20),
                                                     (3, [(90, "a b")], 120)])
def test_against_brute_force(spark, make_docs, seed, short, part_bytes):
    rows, items = case(seed)
    rows += [(None, items[0][1]), (7, rows[3][1]), (7, rows[3][1]), (500, None), (501, ""), (502, "--- !")]
    items = items + short + [(4, items[4][1]), (None, items[5][1]), (93, None), (4, "another item with the same id as that other one, number four")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(make_docs(rows, ["items", "hits", "row", "n_hit"]), benchmark, part_bytes=part_bytes)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, items)


def test_longest_matches(spark, make_docs):
    rows, items = case(5, n=25, vocabulary=4)
    want = set()
    for doc, text in rows:
        own = words(text)
        for item, t in items:
            w = words(t)
            for i in range(len(own)):
                for j in range(len(w)):
                    n = 0
                    while i + n < len(own) and j + n < len(w) and own[i + n] == w[j + n]:
                        n += 1
                    if n >= 10 and (i == 0 or j == 0 or own[i - 1] != w[j - 1]):
                        want.add((doc, str(item), j, i, n))
    got = [tuple(r) for r in longest_matches(make_docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_affected_documents_go(spark, make_docs, long_text):
    passage = " ".join("p%d" % i for i in range(12))
    rows = [(1, "clean"), (2, f"x {passage.upper()} y"), (3, None), (4, long_text), (5, long_text + " " + passage), (None, "")]
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = make_docs(rows, ["row", "items", "n_words"])
    left = decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == [1, 3, 4, None]


def test_empty_tables(spark, make_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(make_docs([]), some).collect() == []
    assert contamination(make_docs([]), nothing).collect() == []
    assert [r.n_hit for r in contamination(make_docs([(1, "a b c"), (2, None)]), nothing).collect()] == [0, 0]
