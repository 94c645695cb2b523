import re

from tidemark.llm.licenses import TEMPLATES, licenses_by_document, scan


def grams(text):
    words = [w for w in re.sub(r"[^\w.]+|_|\.(?![0-9])", " ", text.lower()).split(" ") if w]
    return set(words) if len(words) == 1 else {(a, b) for a, b in zip(words, words[1:])}


def brute(rows, least=0.8):
    known = [(i, name, grams(t), len(t)) for i, (name, t) in enumerate((n, t) for n, ts in TEMPLATES.items() for t in ts)]
    out = set()
    for doc, text in rows:
        text = re.sub("\r\n?", "\n", text or "")
        lines = text.split("\n")
        units = [("line", i, x) for i, x in enumerate(lines)]
        if re.search(r"\n[ \t]*\n", text):
            units += [("paragraph", i, x) for i, x in enumerate(b for b in re.split(r"\n[ \t]*\n", text) if "\n" in b)]
        if len(lines) > 1:
            units.append(("text", 0, text))
        for unit, place, x in units:
            own, best = grams(x), {}
            if not own:
                continue
            for i, name, g, _ in known:
                score = round(2 * len(own & g) / (len(own) + len(g)), 6)
                if score >= least and score > best.get(name, (0, 0))[0]:
                    best[name] = (score, i)
            out |= {(doc, unit, place, name, i, score) for name, (score, i) in best.items()}
    return out


MIT = TEMPLATES["MIT"][2]
ROWS = [(1, "some prose\nLicensed under the Apache License, Version 2.0.\nmore"), (2, MIT), (3, "x\n\n" + "\n".join(MIT.split(". ")) + "\n\ny z"),
        (4, "LICENSED under the  apache license version 2.0"), (5, "Licensed under the Apache License, Version 1.1."), (6, None), (7, ""),
        (8, "All rights reserved."), (9, "All\r\nrights\r\nreserved"), (None, "Released under the MIT License."), (10, "prose " * 50_000 + MIT),
        (1, "Licensed under CC BY-NC 4.0."), (11, MIT.replace("software", "program", 2)), (12, "rights reserved"), (13, "é\n" + TEMPLATES["GPL-3.0"][1]),
        (14, MIT * 10), (15, MIT + "\n" + "-" * 8_000), (16, "x " * 20_000 + "\n" + " ".join([MIT] * 40))]


def test_against_brute_force(make_docs):
    docs = make_docs(ROWS, ["unit", "row", "license", "gram"])
    got = [tuple(r) for r in scan(docs).select("doc_id", "unit", "place", "license", "template", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(ROWS)
    assert {(r[0], r[3]) for r in got} >= {(1, "Apache-2.0"), (2, "MIT"), (3, "MIT"), (4, "Apache-2.0"), (9, "Proprietary"), (13, "GPL-3.0")}


def test_repeated_rows_and_columns(make_docs):
    docs = make_docs([(1, "All rights reserved."), (1, "All rights reserved.")], ["score"])
    got = scan(docs, columns=("doc_id", "source"))
    assert got.count() == 2 and got.columns == ["doc_id", "source", "unit", "place", "license", "template", "score"]


def test_by_document_and_empty_table(make_docs):
    found = {r.doc_id: (r.license, r.n_matches, r.licenses) for r in licenses_by_document(make_docs(ROWS)).collect()}
    assert found[1] == ("CC-BY-NC-4.0", 2, ["Apache-2.0", "CC-BY-NC-4.0"]) or found[1][0] in ("Apache-2.0", "CC-BY-NC-4.0")
    assert 6 not in found and found[10][0] == found[14][0] == found[15][0] == "MIT"
    assert scan(make_docs([])).collect() == []


def test_no_python_on_the_way(make_docs):
    plan = scan(make_docs(ROWS[:2]))._jdf.queryExecution().toString()
    assert not re.search("PythonUDF|Pandas|ArrowEval|MapInArrow", plan)
