import hashlib
import re
from collections import defaultdict

import pytest

from tidemark.llm.exact import exact_dedup, keep_one


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub("[A-Z]", lambda m: m.group().lower(), t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [2, 64, 10_000])
def test_against_brute_force(make_docs, prose, least):
    texts = prose(400) + ["Same text"] * 150 + ["same TEXT"] * 30 + ["İ", "i̇", "É", "é"]
    rows = list(enumerate(texts)) + [(5, "again"), (5, "again"), (None, "again"), (None, "alone"), (None, "alone")]
    got = exact_dedup(make_docs(rows, ["kept", "digest", "key"]), least=least)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_few_counters_lose_nothing(make_docs, prose):
    rows = list(enumerate(prose(300) + ["hot"] * 200))
    got = exact_dedup(make_docs(rows), top=1, counters=8, least=2)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_one_row_of_each_text_stays(make_docs):
    docs = make_docs([(1, "a"), (2, "A"), (2, "A"), (3, None), (4, ""), (None, "z")], ["kept_id", "sha", "row"])
    left = keep_one(docs)
    assert left.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=repr) == [(2, "A"), (4, ""), (None, "z")]


def test_empty_table(make_docs):
    assert exact_dedup(make_docs([])).collect() == [] and keep_one(make_docs([])).collect() == []


def test_no_python_on_the_way(make_docs):
    plan = exact_dedup(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
