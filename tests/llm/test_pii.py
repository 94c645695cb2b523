import hashlib
import random
import re
import time

import numpy as np
import pytest

from tidemark.llm.pii import KINDS, Lattice, Model, base_spans, by_end, emails, personal_data, redact, span_features, train

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    """The base patterns as they are written down."""
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1]))
                if not 13 <= len(digits) <= 19 or total % 10:
                    continue
            out[kind].append(m.span())
    return out


def odd_texts(n=3_000, seed=1):
    rng = random.Random(seed)
    pieces = ["4111 1111 1111 1111", "4111-1111-1111-1111", "10.0.0.1", "1.2.3.4.5", "256.1.1.1", "a.b@c.de", "x@y", "@", "+1 (988) 555-2485",
              "+", "é", " ", ".", "-", "@b.c", "00000", "٣", "(", ")", "a@b.c@d.e", "%_x@q-1.co.uk", "1.1.1.01", "\n"]
    return ["".join(rng.choice(pieces) if rng.random() < 0.6 else rng.choice("0123456789.+@- ab") for _ in range(rng.randint(0, 25)))
            for _ in range(n)]


def test_base_spans_are_those_of_the_patterns():
    for text in odd_texts():
        assert base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 200_000, "9" * 200_000, "1." * 100_000, "@" * 200_000, "a@" * 100_000, "+1" * 100_000,
                                  "+1" + "(" * 200_000, "1 " * 100_000, "(" * 200_000, "a.b" * 60_000 + "@", "1-(" * 60_000])
def test_long_texts_take_no_squared_time(text):
    model = train(["call +1 (988) 555-2485 now"])
    start = time.process_time()
    model.spans(text)
    assert time.process_time() - start < 20
    assert list(emails("a" * 10)) == []


def test_query_against_the_plain_patterns(make_docs):
    rows = list(enumerate(odd_texts(300, 2))) + [(1000, None), (1001, ""), (None, "x@y.zz"), (7, "x@y.zz"), (7, "x@y.zz"),
                                                 (1002, "word " * 50_000 + "é a@b.cd")]
    got = personal_data(make_docs(rows, ["spans", "base", "n_ip"]))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for i, text in rows:
        base = plain(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k])
        want.append((i, *(len(base[k]) for k in KINDS), hashlib.sha256(joined.encode()).hexdigest(), set(filter(None, joined.split(",")))))
    got = got.collect()
    assert sorted(((*r[:6],) for r in got), key=repr) == sorted((w[:6] for w in want), key=repr)
    by_id = {w[0]: w for w in want}
    for r in got:
        every = list(filter(None, r.spans.split(",")))
        if r.doc_id != 7:
            assert by_id[r.doc_id][6] <= set(every)
        places = [(KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in every]
        assert places == sorted(places) and len(set(every)) == len(every)
    assert personal_data(make_docs([])).collect() == []


def learned():
    rng = random.Random(3)

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while True:
            digits = "4" + number(15)
            if base_spans(digits)["card"]:
                return digits

    return train([f"the text {'phone' if i % 2 else 'thing'} +1 ({number(3)}) 555-{number(4)} and more {card()} x {i} order {number(7)} ref {number(8)} "
                  f"mail abc.{i}@mail{i}.example.com at 12.{i % 200}.3.4 end" for i in range(150)])


def test_added_spans_have_the_right_bounds_and_kinds():
    model = learned()
    text = "call (988) 555-2485 or 988.555.2485, write jane.doe [at] mail [dot] example [dot] com; ids 1234567 and 12345678."
    added = {(k, text[a:b]) for k, a, b in model.spans(text)[1]}
    assert ("phone", "(988) 555-2485") in added
    assert ("phone", "988.555.2485") in added
    assert ("email", "jane.doe [at] mail [dot] example [dot] com") in added
    assert not any("1234567" in s for _, s in added)
    assert model.spans("Version 2.0 of 2024-01-01, chapter 12.3, pages 100-200.")[1] == []
    base = "see +1 (988) 555-2485 here"
    assert model.spans(base)[1] == [("phone", 4, 21)]


def test_segmentation_is_the_best_of_all():
    """The dynamic program against every set of segments without overlaps."""
    from tidemark.llm.pii import segments, span_features
    model = learned()
    model = Model(model.weights, model.transition | {("phone", "phone"): -0.5, ("", "card"): 1.25, ("card", "phone"): 2.5})
    for text in ["988 555 2485 4111", "(988) 555-2485 / 100 200 3000", "12 34 56 78 90 12 34 56"]:
        free = sorted(segments(text), key=lambda s: (s[1], s[0]))
        best = [0.0]

        def extend(i, end, last, total):
            best[0] = max(best[0], total)
            for k in range(i, len(free)):
                a, b = free[k]
                if a >= end:
                    for kind in KINDS:
                        own = model.span_score(kind, span_features(text, a, b))
                        extend(k + 1, b, kind, total + own + model.transition.get((last, kind), 0.0))

        extend(0, 0, "", 0.0)
        found, last, total = model.decode(text, []), "", 0.0
        for kind, a, b in found:
            total += model.span_score(kind, span_features(text, a, b)) + model.transition.get((last, kind), 0.0)
            last = kind
        assert total == pytest.approx(best[0])


def test_field_against_all_segmentations():
    """Likelihood, expectations and the gradient of the field against the sum over every segmentation."""
    text = "tel 988 555 2485 4111 or card 4000/1234/5678/9010 x 12[.]34[.]5[.]6"
    found = list(by_end(text))
    names = sorted({f for a, b in found for f in span_features(text, a, b)})
    features = [tuple(names.index(f) for f in span_features(text, a, b)) for a, b in found]
    rng = np.random.default_rng(4)
    weights, transition = rng.normal(size=(len(names), 4)) * 0.4, rng.normal(size=(5, 4))
    known = [s for s in found if text[s[0]:s[1]] in ("988 555 2485", "12[.]34[.]5[.]6")]
    right = np.zeros((len(found), 4))
    for i, (a, b) in enumerate(found):
        if (a, b) in known:
            right[i, 3 if a < 10 else 1] = 1
        elif not any(a < y and x < b for x, y in known):
            right[i] = i % 2
    lattice = Lattice(found, features, right, known)

    def every(only_right):
        def extend(i, end, last, total, chosen):
            if not only_right or {found[j] for j, _ in chosen} >= set(known):
                yield total, chosen
            for j in range(i, len(found)):
                if found[j][0] >= end:
                    for c in range(4):
                        if not only_right or right[j, c]:
                            score = weights[list(features[j])].sum(axis=0)[c] + transition[last, c]
                            yield from extend(j + 1, found[j][1], c + 1, total + score, [*chosen, (j, c)])
        return list(extend(0, 0, 0, 0.0, []))

    def log_sum(only_right):
        return np.logaddexp.reduce([total for total, _ in every(only_right)])

    for only_right in (False, True):
        ways = every(only_right)
        scores = np.array([weights[list(f)].sum(axis=0) for f in features])
        log, chance, moves = lattice.expectations(scores, transition, only_right)
        whole = log_sum(only_right)
        assert len(ways) > 3 and log == pytest.approx(whole)
        want, want_moves = np.zeros_like(chance), np.zeros_like(moves)
        for total, chosen in ways:
            last = 0
            for j, c in chosen:
                want[j, c] += np.exp(total - whole)
                want_moves[last, c] += np.exp(total - whole)
                last = c + 1
        assert chance == pytest.approx(want) and moves == pytest.approx(want_moves)
    # The gradient of the likelihood by a small step of one transition.
    slope = lattice.expectations(scores, transition, True)[2] - lattice.expectations(scores, transition, False)[2]
    for p, c in ((0, 3), (4, 1), (2, 2)):
        ends = []
        for h in (1e-5, -1e-5):
            transition[p, c] += h
            ends.append(log_sum(True) - log_sum(False))
            transition[p, c] -= h
        assert slope[p, c] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-6)


def test_every_kind_is_added_and_transitions_are_learned():
    model = learned()
    text = "host 12[.]34[.]56[.]78 and 4000/1234/5678/9017, phone (988) 555-2485, mail jo [at] mail [dot] org"
    assert {k for k, _, _ in model.spans(text)[1]} == set(KINDS)
    assert any(abs(v) > 0.05 for v in model.transition.values())
    assert train([]).spans(text)[1] == []


def test_redaction(make_docs):
    docs = make_docs([(1, "mail a@b.cd or 10.0.0.1"), (2, None), (3, "clean")])
    assert {r.doc_id: r.text for r in redact(docs).collect()} == {1: "mail <email> or <ip>", 2: None, 3: "clean"}


def test_every_number_of_a_long_run_is_a_candidate():
    from tidemark.llm.pii import regions, segments
    row = "555 123 4567 555 234 5678 555 345 6789 555 456 7890"
    found = {row[a:b] for a, b in segments(row)}
    assert {"555 123 4567", "555 234 5678", "555 345 6789", "555 456 7890"} <= found
    assert (0, 20) in segments("41 11 11 11 11 11 11")
    rng = random.Random(5)
    numbers = ["(%03d) %03d-%04d" % (rng.randrange(1000), rng.randrange(1000), rng.randrange(10000)) for _ in range(2_000)]
    text, at = "; ".join(numbers), 0
    found = {(x + a, x + b) for x, y in regions(text) for a, b in segments(text[x:y])}
    for number in numbers:
        assert (at, at + len(number)) in found
        at += len(number) + 2
    spoken = "jane.doe [at] " + " [dot] ".join(["mail"] * 30)
    assert [spoken[a:b] for a, b in regions(spoken)] == [spoken]


def test_overlapping_spans_are_replaced_as_one(spark, make_docs, monkeypatch):
    docs = make_docs([(1, "mail +123456789-0@ex.com now"), (2, None), (3, "nothing")])
    monkeypatch.setattr(Model, "spans", lambda self, text: ([], [("phone", 5, 17), ("email", 15, 24), ("ip", 25, 28)] if "mail" in text else []))
    got = {r.doc_id: r.text for r in redact(docs, train([])).collect()}
    assert got == {1: "mail <phone/email> <ip>", 2: None, 3: "nothing"}
