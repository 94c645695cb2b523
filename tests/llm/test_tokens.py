import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.tokens import Counted, Tree, apply_edits, count_before_and_after, count_tokens, cut, encoder, VOCABULARY

PIECES = ["word", " word", "  ", "\n", "\n\n", "'s", "'", "ll", "é", "日本", "123", " 45", "!", " !?", "\t", " ", "a", "x" * 50, "\r\n", "🙂"]


def whole(text):
    return len(encoder(VOCABULARY).encode_ordinary(text))


def odd(rng, n):
    return "".join(rng.choice(PIECES) for _ in range(n))


@pytest.mark.parametrize("leaf", [1, 7, 40, 1000])
def test_edits_keep_the_count_of_the_whole(leaf):
    rng = random.Random(leaf)
    for _ in range(60):
        counted = Counted(odd(rng, rng.randint(0, 150)), leaf=leaf)
        assert counted.tokens == whole(counted.text)
        for _ in range(12):
            at = rng.randint(0, len(counted.text) + 3)
            deleted, inserted = rng.choice([0, 1, 2, 9, 60]), odd(rng, rng.choice([0, 0, 1, 2, 30]))
            old = counted.text
            counted.edit(at, deleted, inserted)
            at = min(at, len(old))
            assert counted.text == old[:at] + inserted + old[at + deleted:]
            assert counted.tokens == whole(counted.text)
            tree = counted.tree
            assert sum(tree.length[tree.size:tree.size + tree.n]) == len(counted.text) == tree.length[1]


def test_an_edit_encodes_its_surroundings_only():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(50_000))
    counted = Counted(text)
    before = counted.encoded
    counted.edit(len(text) // 2, 3, "new")
    assert counted.encoded - before < 4_000 and counted.tokens == whole(counted.text)


def test_pieces_and_tree():
    text = "ab cd  ef\n gh ij"
    assert "".join(cut(text, 2)) == text and cut("", 5) == [] and cut("x" * 99, 5) == ["x" * 99]
    tree = Tree([3, 1, 5], [1, 2, 3])
    assert [tree.find(i) for i in (0, 2, 3, 4, 8, 99)] == [(0, 0), (0, 0), (1, 3), (2, 4), (2, 4), (2, 4)]
    tree.replace(1, [7], [9])
    assert (tree.length[1], tree.tokens[1]) == (15, 13)


def test_tables(spark, make_docs, long_text):
    rng = random.Random(2)
    rows = [(i, odd(rng, 80)) for i in range(40)] + [(100, None), (101, ""), (102, long_text), (None, "a b"), (5, "a b"), (5, "a b")]
    docs = make_docs(rows, ["row", "n_tokens"])
    state = count_tokens(docs)
    got = state.collect()
    assert sorted((r.n_tokens for r in got)) == sorted(whole(t or "") for _, t in rows)
    assert state.columns[:len(docs.columns) - 1] == [c for c in docs.columns if c != "n_tokens"]
    assert all(sum(r.leaf_tokens) == r.n_tokens for r in got)
    edits = F.expr("array(named_struct('at', 3L, 'deleted', 2L, 'inserted', ' new'), "
                   "named_struct('at', 0L, 'deleted', 1L, 'inserted', cast(null as string)), null)")
    edited = state.withColumn("edits", edits)
    texts = sorted(((t or "")[:3] + " new" + (t or "")[5:])[1:] for _, t in rows)
    changed = apply_edits(edited).collect()
    assert sorted(r.text for r in changed) == texts
    for r in changed:
        assert r.n_tokens == whole(r.text) and sum(r.leaf_chars) == len(r.text)
    assert next(r for r in changed if r.doc_id == 102).n_chars_encoded < 10_000
    both = {(r.doc_id, r.n_tokens): r for r in count_before_and_after(docs.withColumn("edits", edits)).collect()}
    for i, t in rows:
        t = t or ""
        new = t[:3] + " new" + t[5:]
        assert both[i, whole(t)].n_tokens_edited == whole(new[1:])
    assert both[102, whole(long_text)].n_chars_encoded < 10_000
    unchanged = apply_edits(edited.withColumn("edits", F.lit(None).cast(edited.schema["edits"].dataType)))
    assert all(r.n_leaves_encoded == 0 and r.n_tokens == whole(r.text) for r in unchanged.collect())


def test_foreign_and_stale_trees_are_counted_anew(spark, make_docs):
    """Trees joined by an id that repeats, of an earlier text, or null."""
    docs = make_docs([(1, "a b c d"), (1, "quite another text"), (2, "one two"), (3, None)])
    trees = count_tokens(docs)
    nothing = F.expr("cast(null as array<struct<at: bigint, deleted: bigint, inserted: string>>)")
    joined = docs.join(trees.select("doc_id", "leaf_chars", "leaf_tokens", "tree_digest"), "doc_id")
    assert joined.count() == 6
    stale = trees.withColumn("text", F.concat(F.lit("new "), F.coalesce("text", F.lit(""))))
    broken = trees.withColumn("leaf_tokens", F.lit(None).cast("array<bigint>"))
    for rows in (joined, stale, broken):
        for r in apply_edits(rows.withColumn("edits", nothing)).collect():
            assert r.n_tokens == whole(r.text) == sum(r.leaf_tokens)
    again = apply_edits(apply_edits(trees.withColumn("edits", F.expr(
        "array(named_struct('at', 1L, 'deleted', 1L, 'inserted', 'xyz'))"))).drop("n_leaves_encoded", "n_chars_encoded").withColumn("edits", nothing))
    assert all(r.n_tokens == whole(r.text) and r.n_chars_encoded == 0 for r in again.collect())


def test_edits_keep_the_places_of_leaves():
    """Small changes of the number of pieces leave the tree as it is; a long insert lays it out anew."""
    counted = Counted("word " * 2_000 + "end", leaf=100)
    n = counted.tree.n
    for at, deleted, inserted in [(500, 0, "some more words here " * 8), (900, 250, ""), (40, 3, "x")]:
        counted.edit(at, deleted, inserted)
        assert counted.tree.n == n and counted.tokens == whole(counted.text)
    counted.edit(700, 0, "many more words " * 200)
    assert counted.tree.n > n and counted.tokens == whole(counted.text)


def test_empty_table(make_docs):
    assert count_tokens(make_docs([])).collect() == []
