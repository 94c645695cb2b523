import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, source]) to a documents table with further columns whose names clash with results."""

    def make(rows, extra=()):
        schema = DOCS + "".join(f", `{c}` string" for c in extra)
        data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), *("x" for _ in extra)) for r in rows]
        return spark.createDataFrame(data, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented prose with copies, near copies, nulls, empty and odd texts."""

    def write(n, seed=1, vocabulary=300):
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
        texts = []
        for i in range(n):
            kind = rng.random()
            if texts and kind < 0.15:
                texts.append(rng.choice(texts))
            elif texts and kind < 0.4:
                own = (rng.choice(texts) or "x").split(" ")
                for _ in range(rng.randint(1, 3)):
                    own[rng.randrange(len(own))] = rng.choice(words)
                texts.append(" ".join(own))
            elif kind < 0.45:
                texts.append(rng.choice([None, "", "  \n\t", "one", "ONE", "a b c", "A b\tc", "  x", "é É é É é É"]))
            else:
                texts.append(" ".join(rng.choice(words).upper() if rng.random() < 0.1 else rng.choice(words)
                                      for _ in range(rng.choice([3, 5, 12, 40, 90]))))
        return texts

    return write


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="session")
def long_text():
    rng = random.Random(3)
    return " ".join("w%d" % rng.randrange(5_000) for _ in range(200_000))


