"""Structure repair of conversations by a shortest path over whole numbers.

A conversation's roles should read ``(s?(ua)+)?`` by their initials. Edits: Keep (0), Rerole to user or assistant (2),
Delete (3), Insert of an empty user or assistant turn (2); a truncated row that is not deleted adds 1. The cheapest
edits are a shortest path through the rows times the four states of the pattern. A path's weight is one whole number:
the high digits carry its cost, the low digits, of fixed width and as many as the longest repair has letters, hold its
audit letters from the left, with zeros behind the last one. The smallest number is the cheapest repair and, among
equally cheap ones, the one whose audit is least in ASCII, so that plain ``min`` decides every step.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.shipping import ship_with_tasks

ship_with_tasks(__name__)

# Costs and names of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LETTERS = "DIKR"  # in ASCII order; the digit of a letter is its place from 1
_D, _I, _K, _R = 1, 2, 3, 4
DIGIT = 3  # bits of a letter
ROLES = {"u": "user", "a": "assistant"}
# States: nothing yet, after s, after u, after a. The state behind each, by the next role's initial.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
# What each state can be given by Rerole or Insert: the initial, and the state behind it.
MADE = tuple(next((i, t) for i, t in steps.items() if i in ROLES) for steps in NEXT)
LEGAL = ("su", "ua", "au")
REMEMBERED = 1 << 16  # decisions that a task keeps for conversations of the same shape


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage of the query, two for a repeated one; a dropped row stays with ``dropped`` set.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it,
    4 sets role ``user``. A null part of the key, a null role and a null text count as one space.
    """
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = (F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20).cast("int")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                known("role").alias("role"), known("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"),
                       F.explode(times).alias("copy")).drop("copy")


# ------------------------------------------------------------------ inside tasks

def longest_audit(n: int) -> int:
    """Letters of the longest cheapest repair of ``n`` rows: deleting all costs 3 a row, an insert costs 2."""
    return n + (DELETE * n + 2 * INSERT) // INSERT


def repair(rows: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair. Two characters a row: the role's initial (another one than s, u, a for any
    other role) and ``d`` where the row must be deleted, ``t`` where it is truncated, ``.`` else."""
    n = len(rows) // 2
    width = DIGIT * longest_audit(n)
    low, top = (1 << width) - 1, width - DIGIT

    def before(rest: int, cost: int, letter: int) -> int:
        """An edit in front of a path: its cost on the high digits, its letter before the others."""
        return rest + (cost << width) - (rest & low) + ((rest & low) >> DIGIT) + (letter << top)

    def with_inserts(best: list[int | None]) -> list[int]:
        for _ in NEXT:
            for state, (_initial, behind) in enumerate(MADE):
                if best[behind] is not None:
                    made = before(best[behind], INSERT, _I)
                    if best[state] is None or made < best[state]:
                        best[state] = made
        return best

    best = with_inserts([0 if state in ENDS else None for state in range(len(NEXT))])
    for i in range(n - 1, -1, -1):
        initial, fault = rows[2 * i], rows[2 * i + 1]
        left = TRUNCATED if fault == "t" else 0
        now = []
        for state, steps in enumerate(NEXT):
            ways = [before(best[state], DELETE, _D)]
            if fault != "d":
                if initial in steps:
                    ways.append(before(best[steps[initial]], left, _K))
                ways.append(before(best[MADE[state][1]], REROLE + left, _R))
            now.append(min(ways))
        best = with_inserts(now)
    found, letters = best[0], []
    for k in range(top, -1, -DIGIT):
        digit = (found >> k) & ((1 << DIGIT) - 1)
        if not digit:
            break
        letters.append(LETTERS[digit - 1])
    return found >> width, "".join(letters)


class _Conversation:
    """What the rows of one conversation leave behind while they stream by: a few bytes a row, no texts."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes, self.seen, self.faults = [], set(), {"d": 0, "D": 0, "t": 0}
        self.low = self.high = self.last_turn = None
        self.turns = self.illegal = self.rows = 0
        self.before = None
        self.cost = self.audit = None

    def meet(self, turn, initial, digest, blank, truncated):
        fault = "."
        if blank:
            fault, kind = "d", "d"
        elif digest in self.seen:
            fault, kind = "d", "D"
        elif truncated:
            fault, kind = "t", "t"
        if fault != ".":
            self.faults[kind] += 1
        self.seen.add(digest)
        if self.rows and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before, self.rows = initial, self.rows + 1
        self.codes.append((initial if initial in ("s", "u", "a") else "-") + fault)
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.turns += 1

    def decide(self, known):
        rows = "".join(self.codes)
        if rows not in known:
            if len(known) >= REMEMBERED or len(rows) > 200:
                known.clear()
            known[rows] = repair(rows)
        self.cost, self.audit = known[rows]
        self.codes, self.seen = None, None
        self.at, self.state, self.hash, self.first = 0, 0, hashlib.sha256(), True

    def _put(self, role, text):
        if not self.first:
            self.hash.update(b"\n")
        self.first = False
        self.hash.update(role.encode())
        self.hash.update(b":")
        self.hash.update(text.encode())

    def _inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            initial, self.state = MADE[self.state]
            self._put(ROLES[initial], "")
            self.at += 1

    def write(self, role, text):
        """The next row with its text: inserts in front of it, then its own edit."""
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._put(role, text)
            self.state = NEXT[self.state][role[:1]]
        elif letter == "R":
            initial, self.state = MADE[self.state]
            self._put(ROLES[initial], text)

    def result(self, known):
        if self.audit is None:
            self.decide(known)
        self._inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.faults["d"], self.faults["D"], self.faults["t"], self.illegal, self.cost, self.audit,
                self.hash.hexdigest())


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_KINDS = [pa.int64()] * 7 + [pa.string()] * 2
_NAMES = [c.split(" ")[0] for c in RESULT.split(", ")]


def _repaired(batches):
    """Rows sorted by conversation; of each first the short rows, then the rows with text."""
    current, out, known = None, [], {}

    def packed():
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(_KINDS)], names=_NAMES)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (
            "conv_id", "with_text", "dropped", "turn", "role", "text", "digest", "blank", "truncated")]
        for conv_id, with_text, dropped, turn, role, text, digest, blank, truncated in zip(*columns):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    out.append(current.result(known))
                current = _Conversation(conv_id)
            if dropped:
                continue
            if not with_text:
                current.meet(turn, role[:1], digest, blank, truncated)
            else:
                if current.audit is None:
                    current.decide(known)
                current.write(role, text)
        if len(out) >= 1_000:
            yield packed()
            out.clear()
    if current is not None:
        out.append(current.result(known))
    yield packed()


# ------------------------------------------------------------------ plan

def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, and optionally ``dropped``): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, null first; rows of one turn by role and then by a digest of role and text, so repeated rows
    lie side by side. A row's first fault counts: blank (no visible character), duplicate (role and text stood before),
    truncated (last visible character not ``.!?``). ``gaps`` are the turns that lack between the smallest and the
    largest. Rows with ``dropped`` are not there, but their conversation is listed: without rows it has zeros, an empty
    audit and the hash of an empty text. Null role or text count as empty; rows without conv_id are one conversation, with
    null as its id. An empty table gives an empty result. Other columns are ignored.

    One shuffle by conversation. Each row travels twice, first without its text: a task holds some 150 bytes a row of one
    conversation while it decides, and no texts; these stream by afterwards into the hash. The decision of one conversation is
    sequential, so a conversation stays in one task, however long it is; its rows are spilled by Spark's sort.
    The work of a conversation of n rows grows with n times the length of a weight (some 8 bits a row).
    """
    given = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      role.alias("role"), text.alias("text"), given.alias("dropped"))
    # The role's length keeps role and text apart.
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    end = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    told = own.select(
        "conv_id", "turn", "role", "text", "dropped", digest.alias("digest"), (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    copies = F.when(F.col("dropped"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    both = told.withColumn("with_text", F.explode(copies)).withColumn("text", F.when(F.col("with_text"), F.col("text")))
    order = ["conv_id", "with_text", F.col("turn").asc_nulls_first(), "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_repaired, RESULT)
