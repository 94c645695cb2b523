"""Toxicity by a weighted finite-state grammar over matched clauses.

Small transducers read the classes of a clause's words and are composed into one: the core (insult
or threat), its target, negation, and reported speech. What they say of each matched clause (for
instance: insult, aimed at someone, not negated, not reported) makes the features of a document; isolated
words are never scored apart from their clause. Which words and word beginnings are insults, how strong
each is, and what each kind of clause counts are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.llm.common import stage, text_of, wrapped

ship_with_tasks(__name__)

THRESHOLD = 0.7
# Labelled documents that the grammar is fitted on, at most.
FIT_ROWS = 20_000
# A learned insult stands in this many different word contexts of toxic documents, and in toxic documents nearly only.
LEAST_CONTEXTS = 12
LEAST_PRECISION = 0.9
PREFIXES = (4, 5, 6, 7)
LEFT_WORDS, RIGHT_WORDS = 8, 4

# Fixed word classes of the grammar.
INSULTS = "idiot moron imbecile stupid scum filth worthless pathetic loser trash dumb jerk".split()
THREATS = "kill hurt destroy beat shoot stab strangle smash crush töten schlagen tuer frapper matar golpear".split()
TARGETS = """you your yours yourself u ur he him his she her hers they them their du dich dir dein ihr euch
    tu te toi ton vous votre usted ustedes él ella ellos""".split()
NEGATIONS = "not no never neither nor without isn't aren't don't doesn't nicht kein keine nie pas jamais nunca jamás ni".split()
REPORTS = """said says say told tells wrote writes called calls quoted quotes claimed claims reported heard
    sagte sagt schrieb nannte dit disait appelle écrit dijo dice llamó escribió""".split()

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n]")

# Symbols a transducer reads.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


class Transducer:
    """A deterministic machine: ``step[state][symbol]`` is the next state, ``output[state]`` what it says at the end."""

    def __init__(self, step: list[list[int]], output: list):
        self.step, self.output = step, output

    def compose(self, other: "Transducer") -> "Transducer":
        """Both machines reading the same word; the outputs of both."""
        states = list(product(range(len(self.step)), range(len(other.step))))
        number = {s: i for i, s in enumerate(states)}
        step = [[number[self.step[a][x], other.step[b][x]] for x in range(6)] for a, b in states]
        return Transducer(step, [self.output[a] + other.output[b] for a, b in states])

    def read(self, symbols) -> int:
        state = 0
        for x in symbols:
            state = self.step[state][x]
        return state


def _core() -> Transducer:
    """State 0: nothing yet; 1: insult; 2: threat."""
    rows = []
    for state in range(3):
        row = [state] * 6
        row[INSULT] = 1
        row[THREAT] = state or 2
        rows.append(row)
    return Transducer(rows, [("none",), ("insult",), ("threat",)])


def _before_core(trigger: int, scope: int, name: str, also_after: bool) -> Transducer:
    """Says ``name`` if ``trigger`` stands at most ``scope`` words before the core, or anywhere behind it if asked.

    States 0..scope: words of scope left; scope + 1: core read without trigger; scope + 2: core read with it.
    """
    missed, met = scope + 1, scope + 2
    rows = []
    for state in range(scope + 1):
        row = [max(0, state - 1)] * 6
        row[trigger] = scope
        row[INSULT] = row[THREAT] = met if state else missed
        rows.append(row)
    after = [missed] * 6
    if also_after:
        after[trigger] = met
    rows += [after, [met] * 6]
    return Transducer(rows, [("",)] * (scope + 1) + [("",), (name,)])


def grammar() -> Transducer:
    """Core, target, negation and reported speech, composed."""
    return _core().compose(_before_core(TARGET, 4, "target", True)).compose(
        _before_core(NEGATION, 3, "negated", False)).compose(_before_core(REPORT, LEFT_WORDS, "reported", False))


KINDS = [k for k in product(("insult", "threat"), ("", "target"), ("", "negated"), ("", "reported"))]
# What no clause, an insult and a threat are taken to weigh before any label is seen.
PRIOR = np.array([-3.0, 5.0, 2.0])


def kind_prior(bias: float, insult: float, threat: float) -> np.ndarray:
    """Weights of all kinds of clauses from those of their cores: a target adds, negation and reported speech take off a third."""
    return np.array([bias] + [
        (insult if core == "insult" else threat if target else threat / 4) * (1.0 - 0.35 * bool(negated) - 0.35 * bool(reported))
        + (1.0 if target else 0.0) for core, target, negated, reported in KINDS])


def cores_only(features: np.ndarray) -> np.ndarray:
    """Strength of all insults and of all threats of each row, whatever stands around them."""
    of = np.array([core for core, *_ in KINDS])
    return np.column_stack([1.0 - np.prod(1.0 - features[:, of == c], axis=1) for c in ("insult", "threat")])


class Scanner:
    """Finds the cores of a text by one automaton over all of them and reads the words around each."""

    def __init__(self, insults: dict[str, float]):
        """``insults``: strength (0 to 1) of whole words (ending in ``$``) and of word beginnings."""
        self.machine = grammar()
        self.kind = {s: KINDS.index(out) for s, out in enumerate(self.machine.output) if out in KINDS}
        self.symbols = {w: s for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}
        self.cores = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for term, strength in insults.items():
            entries.setdefault(term.rstrip("$"), []).append((INSULT, term.endswith("$"), strength))
        for word in THREATS:
            entries.setdefault(word, []).append((THREAT, True, 1.0))
        for text, found in entries.items():
            self.cores.add_word(text, (len(text), found))
        if len(self.cores):
            self.cores.make_automaton()

    def features(self, text: str) -> np.ndarray:
        """For each kind of clause, 0 without any, rising to 1 with the strength of those found."""
        sums = np.zeros(len(KINDS))
        text = text.lower()
        if not len(self.cores):
            return sums
        best: dict[int, tuple[float, int, int]] = {}
        for last, (size, found) in self.cores.iter(text):
            first = last - size + 1
            if first and text[first - 1].isalpha():
                continue
            for symbol, whole, strength in found:
                if whole and last + 1 < len(text) and text[last + 1].isalpha():
                    continue
                if first not in best or strength > best[first][0]:
                    best[first] = (strength, symbol, last + 1)
        if not best:
            return sums
        # Words and clause ends of the whole text, each looked for once.
        words = [m.span() for m in WORD.finditer(text)]
        starts, stops = [a for a, _ in words], [b for _, b in words]
        ends = [m.start() for m in CLAUSE_END.finditer(text)]
        for first, (strength, symbol, end) in best.items():
            while end < len(text) and text[end].isalpha():
                end += 1
            clause = bisect_left(ends, first)
            begin = ends[clause - 1] + 1 if clause else 0
            word = bisect_left(starts, first)
            left = text[max(begin, starts[max(0, word - LEFT_WORDS - 1)] if word else 0):first]
            clause = bisect_left(ends, end)
            word = bisect_left(stops, end) + RIGHT_WORDS + 1
            right = text[end:min(ends[clause] if clause < len(ends) else len(text), stops[word] if word < len(stops) else len(text))]
            before = [self.symbols.get(w, OTHER) for w in WORD.findall(left)[-LEFT_WORDS:]]
            after = [self.symbols.get(w, OTHER) for w in WORD.findall(right)[:RIGHT_WORDS]]
            sums[self.kind[self.machine.read([*before, symbol, *after])]] += strength
        return 1.0 - np.exp(-2.0 * sums)


def _terms(word: str) -> list[str]:
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) >= k)]


def _contexts(batches):
    """Of toxic documents: each term with the words around it, once a batch."""
    for batch in batches:
        seen, docs = set(), Counter()
        for text in batch.column("text").to_pylist():
            words = ["", *WORD.findall(text.lower()), ""]
            own = set()
            for before, word, after in zip(words, words[1:], words[2:]):
                for term in _terms(word):
                    own.add(term)
                    seen.add((term, zlib.crc32(f"{before} {after}".encode())))
            docs.update(own)
        rows = [(t, c, 0) for t, c in seen] + [(t, None, n) for t, n in docs.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64())], names=["term", "context", "docs"])


def _presence(wanted):
    """Of clean documents: how many hold each wanted term, by batch."""
    def run(batches):
        terms = wanted.value
        for batch in batches:
            docs = Counter()
            for text in batch.column("text").to_pylist():
                own = set()
                for word in set(WORD.findall(text.lower())):
                    own.update(t for t in _terms(word) if t in terms)
                docs.update(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64())], names=["term", "docs"])
    return run


def _featured(model):
    def run(batches):
        scanner = Scanner(model.value)
        for batch in batches:
            found = [scanner.features(t or "").round(6).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "features"])
    return run


def _scored(model):
    def run(batches):
        insults, weights = model.value
        scanner = Scanner(insults)
        for batch in batches:
            found = np.array([scanner.features(t or "") for t in text_of(batch).to_pylist()]).reshape(-1, len(KINDS))
            score = 1.0 / (1.0 + np.exp(-(weights[0] + found @ weights[1:])))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score)], names=["row", "score"])
    return run


# ------------------------------------------------------------------ fitting

def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents that are not held out, each text once.

    The documents are those with the smallest hashes of doc_id; the ids are few enough to be broadcast.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    few = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(few), "doc_id").groupBy("text").agg(
        F.max("toxic").cast("int").alias("toxic"))


def logistic(features: np.ndarray, labels: np.ndarray, counts: np.ndarray, prior: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps for logistic regression with a ridge towards ``prior``."""
    x = np.column_stack((np.ones(len(features)), features))
    w = prior.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (p - labels)) + ridge * (w - prior)
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learned_insults(sample: DataFrame, contexts: int = LEAST_CONTEXTS, precision: float = LEAST_PRECISION) -> dict[str, float]:
    """Words and word beginnings of the insult class, with strengths.

    Wanted are terms in many different word contexts of toxic documents (copies of one text repeat its contexts, so
    they do not count again) that clean documents hardly hold. Of terms with the same documents the most exact stays.
    """
    sc = sample.sparkSession.sparkContext
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    found = sample.where("toxic = 1").select("text").mapInArrow(_contexts, "term string, context long, docs long")
    held = {r.term: r.docs for r in found.groupBy("term").agg(
        F.count_distinct("context").alias("contexts"), F.sum("docs").alias("docs")).where(F.col("contexts") >= contexts).collect()}
    fixed = {w + "$": 0.5 for w in INSULTS}
    wanted = sc.broadcast(frozenset(held) | frozenset(fixed))
    against = {r.term: r.docs for r in sample.where("toxic = 0").select("text").mapInArrow(
        _presence(wanted), "term string, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).collect()}
    strength = {}
    for term, n in held.items():
        other = against.get(term, 0)
        # Shares of toxic and of clean documents, so that the sample's balance does not matter.
        share, rest = (n + 0.5) / (toxic + 1), (other + 0.5) / (clean + 1)
        if n >= precision * (n + other) and share > 8 * rest:
            strength[term] = min(1.0, math.log(share / rest) / 4)
    ordered = sorted(strength)
    exact = {t: s for t, s in strength.items() if not any(held[o] >= 0.95 * held[t] for o in _longer(t, ordered))}
    # A fixed word stays where the clean documents do not speak against it.
    return {w: s for w, s in fixed.items() if against.get(w, 0) <= held.get(w, 0)} | exact


def _longer(term: str, ordered: list[str]) -> list[str]:
    """The terms that ``term`` is a beginning of."""
    if term.endswith("$"):
        return []
    end = bisect_left(ordered, term + chr(0x10FFFF))
    return [o for o in ordered[bisect_left(ordered, term):end] if o != term]


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """The insult class and the weights of the kinds of clauses. Without labels: the fixed words and prior weights."""
    sample = stage(fit_sample(docs, labels, rows), "fit-sample")
    sc = docs.sparkSession.sparkContext
    insults = learned_insults(sample)
    found = sample.select("text", "toxic").mapInArrow(
        _featured(sc.broadcast(insults)), "toxic int, features array<double>").groupBy("toxic", "features").agg(
        F.count(F.lit(1)).alias("n")).collect()
    if not found:
        return insults, kind_prior(*PRIOR)
    features = np.array([r.features for r in found])
    labels_, counts = np.array([float(r.toxic) for r in found]), np.array([float(r.n) for r in found])
    # First what the cores weigh, then each kind near its core's weight: a kind that the sample lacks keeps it.
    cores = logistic(cores_only(features), labels_, counts, PRIOR)
    return insults, logistic(features, labels_, counts, kind_prior(*cores))


# ------------------------------------------------------------------ scoring

def score(docs: DataFrame, model: tuple[dict[str, float], np.ndarray], columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The given columns of every row and its score between 0 and 1. Null and empty texts match no clause."""
    spark = docs.sparkSession
    rows = docs.select(wrapped(docs, columns), *([] if "text" in columns else ["text"]))
    return rows.mapInArrow(_scored(spark.sparkContext.broadcast(model)),
                           f"row {rows.schema['row'].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels are read only of rows whose crc32(doc_id) mod 3 is not 1 (``held_out`` false; false for a null doc_id too).
    Null labels are skipped; of repeated labels of a doc_id the toxic one counts. Only the text is scored, the whole of
    it, so rows with equal texts have equal scores. Other columns are ignored. An empty table gives an empty result;
    without labels the fixed words and prior weights decide.
    """
    return score(docs, fit(docs, labels, rows)).select(
        F.col("row.doc_id").alias("doc_id"), F.coalesce(held_out(F.col("row.doc_id")), F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    return score(docs, fit(docs, labels), tuple(docs.columns)).where(F.col("score") < threshold).select("row.*")
