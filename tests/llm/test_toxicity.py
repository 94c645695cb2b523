import random
import zlib

import numpy as np
import pytest

from tidemark.llm.toxicity import KINDS, PRIOR, Scanner, cores_only, grammar, kind_prior, logistic, reject_toxic, toxicity


def label(text, insults=("idiot",)):
    found = Scanner({w + "$": 1.0 for w in insults} | {"grob": 1.0}).features(text)
    return sorted("+".join(filter(None, KINDS[k])) for k in np.flatnonzero(found))


@pytest.mark.parametrize("text, kinds", [
    ("nothing here", []), ("what an idiot.", ["insult"]), ("You are an IDIOT", ["insult+target"]), ("idiot that you are", ["insult+target"]),
    ("he is not an idiot", ["insult+target+negated"]), ("they called them an idiot", ["insult+target+reported"]),
    ("not now. idiot", ["insult"]), ("said he. idiot", ["insult"]), ("idiots", []), ("anidiot", []), ("grober klotz", ["insult"]),
    ("I will kill you", ["threat+target"]), ("to kill time", ["threat"]), ("never kill them", ["threat+target+negated"]),
    ("not a b c d e f idiot", ["insult"]), ("idiot not", ["insult"]), ("", []),
    ("he said " + "a" * 230 + " idiot", ["insult+target+reported"]), ("not " + "b" * 204 + " an idiot", ["insult+negated"]),
    ("idiot " + "c" * 300 + " you", ["insult+target"]), ("not " + "w " * 8 + "idiot " + "x " * 4 + "you", ["insult"]),
    ("word " * 50_000 + "you idiot " + "word " * 50_000, ["insult+target"])])
def test_clauses(text, kinds):
    assert label(text) == kinds


def test_composition_reads_like_its_parts():
    rng = random.Random(1)
    machine = grammar()
    for _ in range(500):
        symbols = [rng.randrange(6) for _ in range(rng.randint(0, 12))]
        core = next((x for x in symbols if x == 1), next((x for x in symbols if x == 2), None))
        said = machine.output[machine.read(symbols)]
        assert (said[0] == "none") == (core is None)
        if symbols and symbols[0] in (1, 2) and 3 in symbols:
            assert said[1] == "target"


def test_logistic_regression_finds_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.random((400, len(KINDS)))
    y = (rng.random(400) < 1 / (1 + np.exp(-(3 * x[:, 0] - 2 * x[:, 1])))).astype(float)
    prior = kind_prior(*PRIOR)
    w = logistic(x, y, np.ones(400), prior)
    z = np.column_stack((np.ones(400), x))
    gradient = z.T @ (1 / (1 + np.exp(-z @ w)) - y) + 0.1 * (w - prior)
    assert np.abs(gradient).max() < 1e-6
    assert cores_only(np.eye(len(KINDS))).sum(axis=1).tolist() == [1.0] * len(KINDS)


@pytest.fixture(scope="module")
def corpus():
    """Prose in which invented insults (two words, one beginning) stand at random places of toxic texts."""
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice(["zonk", "Blorf", "qrux" + "".join(rng.choice("abc") for _ in range(3))]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, make_docs, corpus):
    rows, labels = corpus
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    # Wrong labels in the held-out part must not matter.
    shown = [(i, 1 - t if i in set(held) else t) for i, t in labels] + [(None, 1), (3, None), (99_999, 1)]
    got = toxicity(make_docs(rows + [(5000, None), (5001, ""), (None, "you zonk")], ["score", "row", "toxic"]),
                   spark.createDataFrame(shown, "doc_id long, toxic int"))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r.doc_id: r for r in got.collect()}
    assert {i for i, r in got.items() if r.held_out} - {5000, 5001} == set(held)
    right = dict(labels)
    assert sum(got[i].predicted == right[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert got[5000].score == got[5001].score and got[None].predicted == 1 and not got[None].held_out


def test_nothing_to_learn_from(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity(make_docs([(1, "you are a stupid idiot"), (2, "a quiet day"), (3, None)]), none).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    assert toxicity(make_docs([]), none).collect() == []


def test_rejected_documents_go(spark, make_docs, corpus):
    rows, labels = corpus
    docs = make_docs(rows + [(7000, None), (7000, None)], ["score", "row"])
    left = reject_toxic(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert left.columns == docs.columns
    kept = [r.doc_id for r in left.collect()]
    clean = {i for i, t in labels if not t}
    assert kept.count(7000) == 2 and len(clean & set(kept)) >= 0.99 * len(clean) and len(set(kept) - clean - {7000}) < 10
