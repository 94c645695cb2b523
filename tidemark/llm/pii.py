"""Personal data by a semi-Markov conditional random field.

Candidate segments of a text (addresses, dotted numbers, runs of digits) are scored as whole spans: how many digits in
which groups, which separators, which word stands before; transitions score which kind follows which. A dynamic program
over the segments of a region chooses boundaries and kinds together. Four exact base patterns are always part of the
result; the field adds spans beside them. Weights and transitions are learned together, by the likelihood of whole
regions: base spans of a bounded sample are shown in the forms that the base patterns miss (without plus, with other
separators, spelled out), and digit runs that look like such a form are left open instead of being taught as no kind.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.llm.common import unit_interval

ship_with_tasks(__name__)

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS = 2_000
# Of one sample text the field sees at most so many regions without base spans, evenly drawn, and none of more code points.
FIT_REGIONS, FIT_LENGTH = 40, 1_000
# Base spans that are shown together at most.
FIT_GROUP = 6
# The longest span the model considers, in code points.
LONGEST = 64

HINT = re.compile(r"[0-9@]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPOKEN = re.compile(r"(?<![\w.])[A-Za-z0-9._%+-]{1,40} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,30}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,20})+")
DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?(?:[\[(]\.[\])]|[\[(]dot[\])]) ?[0-9]{1,3}){3}(?![0-9])")
DIGITS = re.compile(r"\(?[0-9](?:[0-9 ().\-/]*[0-9])?")
WORD_BEFORE = re.compile(r"([^\W\d_]+)[^\w\n]{0,3}$")
# Fixed cue words of the features, by kind.
CUES = {"phone": "tel phone telephone call mobile cell fax telefon rufen handy téléphone teléfono".split(),
        "card": "card visa mastercard credit karte carte tarjeta".split(),
        "email": "mail email contact write".split(), "ip": "ip host server address".split()}


# ------------------------------------------------------------------ base patterns

def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, by their @ signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > free and LOCAL.match(text[first - 1]):
            first -= 1
        found = DOMAIN.match(text, at) if first < at else None
        if found:
            yield first, found.end()
            free = found.end()
        else:
            # What was read so far cannot belong to a later address: no address goes across this @.
            free = at + 1
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The four exact patterns, each leftmost and without overlaps of its own kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not HINT.search(text):
        return out
    out["email"] = list(emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = _only_digits(m.group()) if m.end() - m.start() <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out["phone"].append(m.span())
    return out


# ------------------------------------------------------------------ segments and features

def by_end(text: str) -> Iterator[tuple[int, int]]:
    """Candidate segments by end, then start: spoken addresses and dotted numbers, and all that run from one digit group to the same or a
    later one of its run, of 7 digits or more and up to LONGEST code points."""
    spoken = sorted((m.span() for form in (SPOKEN, DEFANGED) for m in form.finditer(text)), key=lambda s: (s[1], s[0]))
    return heapq.merge(_digit_segments(text), spoken, key=lambda s: (s[1], s[0]))


def _digit_segments(text: str) -> Iterator[tuple[int, int]]:
    for m in DIGITS.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in re.finditer(r"[0-9]+", m.group())]
        sums = [0]
        for a, b in groups:
            sums.append(sums[-1] + b - a)
        low = 0
        for j, (_, b) in enumerate(groups):
            while low < j and b - groups[low][0] > LONGEST:
                low += 1
            for i in range(low, j + 1):
                a = groups[i][0]
                if sums[j + 1] - sums[i] < 7 or b - a > LONGEST:
                    break
                if a and text[a - 1] == "(":
                    yield a - 1, b
                yield a, b


def segments(text: str) -> list[tuple[int, int]]:
    return sorted(by_end(text))


def span_features(text: str, first: int, last: int) -> list[str]:
    """Features of a whole span and its surroundings."""
    span = text[first:last]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    out = ["bias", *[f"sep={s}" for s in sorted(set(re.sub(r"[0-9A-Za-z]", "", span)))[:5]]]
    if DEFANGED.fullmatch(span):
        out.append(f"dotted={all(int(g) <= 255 for g in groups)}")
    elif SPOKEN.fullmatch(span):
        out.append("spoken")
    else:
        out += [f"digits={min(len(digits), 20)}", f"groups={min(len(groups), 6)}",
                "shape=" + "-".join(str(min(len(g), 9)) for g in groups[:6]), f"luhn={13 <= len(digits) <= 19 and luhn(digits)}"]
    before, after = text[max(0, first - 24):first], text[last:last + 1]
    out.append("open" if not before or not (before[-1].isalnum() or before[-1] in "+.-/") else "glued")
    out.append("end" if not after or not (after.isalnum() or after in "-/") else "runs on")
    cue = WORD_BEFORE.search(before)
    if cue:
        word = cue.group(1).lower()
        out += [f"cue={kind}" for kind, words in CUES.items() if word in words]
    return out


def familiar(features: list[str], shapes: set[str]) -> list[str]:
    """Shapes that no shown span has are one feature, so that what is said of them holds for shapes never seen."""
    return ["shape=other" if f.startswith("shape=") and f not in shapes else f for f in features]


class Model:
    """Weights by (kind, feature) and (kind before, kind). A segment left out scores 0. Of equal segmentations the one stands
    whose segments end, then start first."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None, transition: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}
        self.transition = transition or {}
        self.shapes = {f for _, f in self.weights if f.startswith("shape=")}
        # What a segment can gain by the transitions around it, by kind: one that loses more is in no best segmentation.
        to = {k: [self.transition.get((p, k), 0.0) for p in ("", *KINDS)] for k in KINDS}
        self.slack = {c: max(to[c]) + max(0.0, *(self.transition.get((c, k), 0.0) - min(to[k]) for k in KINDS)) for c in KINDS}

    def span_score(self, kind: str, features: list[str]) -> float:
        return sum(self.weights.get((kind, f), 0.0) for f in familiar(features, self.shapes))

    def decode(self, text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """The best set of segments without overlaps, beside the taken spans: for each segment end the best way to get
        there, with the last kind as state. Bounded by the longest segment."""
        blocked = _merged(taken)
        starts = [x for x, _ in blocked]
        # best[i]: score and choices over the segments with the first i ends, by the last kind chosen.
        ends: list[int] = []
        best: list[dict[str, tuple[float, tuple]]] = [{"": (0.0, ())}]
        seen: dict[tuple, list[tuple[str, float]]] = {}
        for a, b in by_end(text):
            at = bisect_left(starts, b)
            if at and blocked[at - 1][1] > a:
                continue
            # All that the features look at.
            sight = (text[max(0, a - 24):b + 1], min(a, 24), b - a)
            if sight not in seen:
                if len(seen) >= 20_000:
                    seen.clear()
                features = span_features(text, a, b)
                seen[sight] = [(kind, own) for kind in KINDS if (own := self.span_score(kind, features)) + self.slack[kind] > 0]
            if not seen[sight]:
                continue
            if not ends or ends[-1] < b:
                ends.append(b)
                best.append(dict(best[-1]))
            now, k = best[-1], bisect_right(ends, a)
            for kind, own in seen[sight]:
                for before, (total, way) in best[k].items():
                    value = total + own + self.transition.get((before, kind), 0.0)
                    if kind not in now or value > now[kind][0]:
                        now[kind] = (value, (way, (kind, a, b)))
        _, way = max(best[-1].values(), key=lambda x: x[0])
        out = []
        while way:
            way, last = way
            out.append(last)
        return out[::-1]

    def spans(self, text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
        """Base spans by kind, and all spans by kind and place."""
        base = base_spans(text)
        if not HINT.search(text):
            return base, []
        taken = sorted(s for spans in base.values() for s in spans)
        every = [(k, a, b) for k in KINDS for a, b in base[k]] + self._added(text, taken)
        every.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        return base, every

    def _added(self, text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """Decode region by region; no segment reaches across the bounds of one."""
        out, blocked = [], _merged(taken)
        starts, ends = [x for x, _ in blocked], [y for _, y in blocked]
        for first, last in regions(text):
            near = [(x - first, y - first) for x, y in blocked[bisect_right(ends, first):bisect_left(starts, last)]]
            out += [(k, a + first, b + first) for k, a, b in self.decode(text[first:last], near)]
        return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The places that the spans cover, as sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


RUN = re.compile(r"[0-9][0-9 ().\-/]{5,}[0-9]")


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around whole runs of digits and spoken addresses or numbers, with the context that features look at."""
    held = heapq.merge(*([m.span() for m in form.finditer(text)] for form in (RUN, SPOKEN, DEFANGED)))
    return _merged([(max(0, a - LONGEST), min(len(text), b + LONGEST)) for a, b in held])


# ------------------------------------------------------------------ training

def _shown(kind: str, span: str) -> list[str]:
    """A base span in the forms that the base patterns miss."""
    if kind == "phone":
        local = re.sub(r"^\+[0-9]{1,3}[ .-]*", "", span)
        forms = [local, re.sub(r"[()]", "", local), re.sub(r"[ ().-]+", ".", local).strip(".")]
    elif kind == "card":
        digits = _only_digits(span)
        forms = [sep.join(digits[i:i + 4] for i in range(0, len(digits), 4)) for sep in ("/", ".")]
    elif kind == "email":
        local, domain = span.rsplit("@", 1)
        forms = [local + at + domain.replace(".", dot) for at, dot in ((" [at] ", " [dot] "), ("(at)", "(dot)"))]
    else:
        forms = [span.replace(".", dot) for dot in ("[.]", " [dot] ", "(dot)")]
    return [form for form in forms if form]


def shown_regions(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[str, list[tuple[int, int, str]]]]:
    """Neighbouring base spans (by start) in three forms that the base patterns miss: the text around them with the new
    places. Spans less than LONGEST apart, FIT_GROUP at most, are shown together, so that transitions are seen."""
    groups: list[list[tuple[int, int, str]]] = []
    for span in spans:
        if groups and span[0] < groups[-1][-1][1]:
            continue
        if groups and span[0] - groups[-1][-1][1] < LONGEST and len(groups[-1]) < FIT_GROUP:
            groups[-1].append(span)
        else:
            groups.append([span])
    for group in groups:
        for form in range(3):
            out, places, free = "", [], max(0, group[0][0] - 24)
            for a, b, kind in group:
                forms = _shown(kind, text[a:b])
                out += text[free:a]
                if forms:
                    new = forms[form % len(forms)]
                    places.append((len(out), len(out) + len(new), kind))
                    out += new
                free = b
            yield out + text[free:free + 8], places


class Lattice:
    """The segmentations of one region: segments with features and places, and what is known about them.

    ``right`` tells for each segment and kind whether a right segmentation may hold it, ``bound`` the ends that lie inside
    a known span: no right segmentation passes them by."""

    def __init__(self, found: list[tuple[int, int]], features: list[tuple[int, ...]], right: np.ndarray, known: list[tuple[int, int]]):
        ends = sorted({b for _, b in found})
        self.size = len(ends) + 1
        self.features = features
        self.first = [bisect_right(ends, a) for a, _ in found]
        self.last = [bisect_left(ends, b) + 1 for _, b in found]
        self.right = right
        self.free = np.ones(self.size)
        for a, b in known:
            self.free[bisect_right(ends, a) + 1:bisect_left(ends, b) + 2] = 0.0

    def key(self):
        return (tuple(self.features), tuple(self.first), tuple(self.last), self.right.tobytes(), self.free.tobytes())

    def expectations(self, scores: np.ndarray, transition: np.ndarray, right: bool) -> tuple[float, np.ndarray, np.ndarray]:
        """Log of the summed weights of all segmentations (or of the right ones), the chance of each segment and kind, and
        the expected transitions, by the forward and the backward sums over ends, with the last kind as state."""
        allowed = self.right if right else np.ones_like(self.right)
        free = self.free if right else np.ones(self.size)
        gain = np.exp(scores) * allowed
        steps = np.exp(transition)
        ahead, back = np.zeros((2, self.size, len(KINDS) + 1))
        ahead[0, 0], back[-1] = 1.0, 1.0
        by_last: dict[int, list[int]] = {}
        for i, e in enumerate(self.last):
            by_last.setdefault(e, []).append(i)
        log, scale = 0.0, np.ones(self.size)
        for e in range(1, self.size):
            now = ahead[e - 1] * free[e]
            for i in by_last.get(e, ()):
                k = self.first[i]
                # Sums are scaled end by end, so that long regions stay within range.
                now[1:] += (ahead[k] / np.prod(scale[k + 1:e])) @ steps * gain[i]
            scale[e] = now.sum()
            if not scale[e] > 0:
                scale[e] = 1.0
            ahead[e] = now / scale[e]
            log += np.log(scale[e])
        total = ahead[-1].sum()
        chance, moves = np.zeros_like(gain), np.zeros_like(transition)
        by_first: dict[int, list[int]] = {}
        for i, k in enumerate(self.first):
            by_first.setdefault(k, []).append(i)
        for k in range(self.size - 2, -1, -1):
            back[k] = back[k + 1] * free[k + 1] / scale[k + 1]
            for i in by_first.get(k, ()):
                e = self.last[i]
                onward = gain[i] * back[e][1:] / np.prod(scale[k + 1:e + 1])
                back[k] += steps @ onward
                joint = ahead[k][:, None] * steps * onward / total
                chance[i] = joint.sum(axis=0)
                moves += joint
        return (log + np.log(total) if total > 0 else -np.inf), chance, moves


def lattices(texts: list[str]) -> tuple[list[tuple[Lattice, int]], list[str]]:
    """What the texts show to the field, equal regions once with their number, and the names of the features."""
    names: dict[str, int] = {}
    shown: list[tuple[str, list[tuple[int, int, str]], list[tuple[int, int]]]] = []
    for text in texts:
        base = base_spans(text)
        spans = sorted((a, b, k) for k in KINDS for a, b in base[k])
        shown += [(form, places, []) for form, places in shown_regions(text, spans)]
        others = [(x, y) for x, y in regions(text) if y - x <= FIT_LENGTH]
        for x, y in others[::-(-len(others) // FIT_REGIONS) or 1]:
            shown.append((text[x:y], [], [(a - x, b - x) for a, b, _ in spans if a < y and x < b]))
    shapes = {f for text, places, _ in shown for a, b, _ in places for f in span_features(text, a, b) if f.startswith("shape=")}
    out: dict[tuple, list] = {}
    for text, places, taken in shown:
        found = [(a, b) for a, b in by_end(text) if not any(a < y and x < b for x, y in taken)]
        at = {(a, b): kind for a, b, kind in places}
        known = [s for s in found if s in at]
        if not found or (places and not known):
            continue
        features, right = [], np.zeros((len(found), len(KINDS)))
        for i, (a, b) in enumerate(found):
            held = span_features(text, a, b)
            features.append(tuple(names.setdefault(f, len(names)) for f in familiar(held, shapes)))
            if (a, b) in at:
                right[i, KINDS.index(at[a, b])] = 1
            elif not any(a < y and x < b for x, y, _ in places):
                # It may be one that the base patterns miss: left open.
                right[i] = "open" in held and "end" in held and any(f.startswith("cue=") or f in shapes for f in held)
        lattice = Lattice(found, features, right, known)
        out.setdefault(lattice.key(), [lattice, 0])[1] += 1
    return [tuple(v) for v in out.values()], list(names)


def train(texts: list[str], rounds: int = 15, rate: float = 0.3, decay: float = 1e-3) -> Model:
    """Gradient steps (scaled per weight) on the log likelihood of the known spans of each region, what is open summed over.
    The gradient is the difference of two expectations: over the right segmentations and over all."""
    examples, names = lattices(texts)
    weights, transition = np.zeros((len(names), len(KINDS))), np.zeros((len(KINDS) + 1, len(KINDS)))
    seen_w, seen_t = np.full_like(weights, 1e-2), np.full_like(transition, 1e-2)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(examples)):
            lattice, times = examples[i]
            scores = np.array([weights[list(f)].sum(axis=0) for f in lattice.features])
            _, want, moves_right = lattice.expectations(scores, transition, True)
            _, have, moves = lattice.expectations(scores, transition, False)
            miss = want - have
            if np.abs(miss).max() < 1e-4:
                continue
            push = min(1 + math.log(times), 4.0)
            slope = push * (moves_right - moves) - decay * transition
            seen_t += slope * slope
            transition += rate * slope / np.sqrt(seen_t)
            step = np.zeros_like(weights)
            rows = np.concatenate([np.array(f) for f in lattice.features])
            np.add.at(step, rows, push * np.repeat(miss, [len(f) for f in lattice.features], axis=0))
            rows = np.unique(rows)
            slope = step[rows] - decay * weights[rows]
            seen_w[rows] += slope * slope
            weights[rows] += rate * slope / np.sqrt(seen_w[rows])
    states = ("", *KINDS)
    return Model({(kind, f): float(weights[i, k]) for i, f in enumerate(names) for k, kind in enumerate(KINDS)
                  if weights[i, k] or f.startswith("shape=")},
                 {(states[p], kind): float(transition[p, k]) for p in range(len(states)) for k, kind in enumerate(KINDS)
                  if transition[p, k]})


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Train on at most ``rows`` texts that hold digits or @ signs, those with the smallest hashes."""
    held = docs.select("text").where(F.col("text").rlike("[0-9@]")).where(F.length("text") <= 20_000)
    sized = held.select("text", unit_interval(F.col("text")).alias("draw"))
    n = sized.count()
    few = sized.where(F.col("draw") <= min(1.0, 2 * rows / max(n, 1))).dropDuplicates(["text"]).orderBy("draw", "text").limit(rows)
    return train([r.text for r in few.collect()])


# ------------------------------------------------------------------ scan

def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(model):
    def run(batches):
        known = Model(*model.value)
        for batch in batches:
            counts, base_text, all_text = [], [], []
            for text in batch.column("text").to_pylist():
                base, every = known.spans(text or "")
                counts.append([len(base[k]) for k in KINDS])
                base_text.append(_joined((k, a, b) for k in KINDS for a, b in base[k]))
                all_text.append(_joined(every))
            columns = [pa.array(c, pa.int64()) for c in (zip(*counts) if counts else [[]] * 4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(base_text, pa.string()), pa.array(all_text, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"])
    return run


def personal_data(docs: DataFrame, model: Model | None = None, rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of the base spans; ``spans`` has all spans as kind:start:end, by kind, then start (code
    points, end exclusive). An added span overlaps no base span and no other added one. Null and empty texts have none.
    Rows that repeat a text have equal results; other columns are ignored. An empty table gives an empty result.
    """
    model = model or fit(docs, rows)
    rows_ = docs.select(F.col("doc_id").cast("long"), "text")
    found = rows_.mapInArrow(
        _scan(docs.sparkSession.sparkContext.broadcast((model.weights, model.transition))),
        "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string")
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All columns of ``docs``, with every span of the text replaced by its kind in angle brackets. Spans that overlap are
    replaced as one, by all their kinds. A null text stays null; very long texts are read whole."""
    model = model or fit(docs)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.transition))
    at = docs.columns.index("text")

    def run(batches):
        known = Model(*sent.value)
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                if text:
                    joined = []
                    for kind, a, b in sorted(known.spans(text)[1], key=lambda s: s[1:]):
                        if joined and a < joined[-1][2]:
                            kinds, first, last = joined[-1]
                            joined[-1] = (kinds if kind in kinds else [*kinds, kind], first, max(last, b))
                        else:
                            joined.append(([kind], a, b))
                    free, parts = 0, []
                    for kinds, a, b in joined:
                        parts += [text[free:a], f"<{'/'.join(kinds)}>"]
                        free = b
                    text = "".join([*parts, text[free:]])
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema)
