import hashlib
import random
import re
import zlib
from heapq import heappop, heappush

from tidemark.llm.repair import damaged, longest_audit, repair, repaired

GOOD = re.compile(r"(s?(ua)+)?$")


def cheapest(rows):
    """Uniform search over all edit sequences: cost, audit, and roles of the result with the rows they come from."""
    n, heap, ends, limit = len(rows) // 2, [(0, "", 0, "", ())], [], None
    while heap:
        cost, audit, i, roles, kept = heappop(heap)
        if limit is not None and cost > limit:
            break
        if not re.match(r"s?(ua)*u?$", roles):
            continue
        if i == n and GOOD.match(roles):
            ends.append((cost, audit, roles, kept))
            limit = cost
            continue
        for x in "ua":
            heappush(heap, (cost + 2, audit + "I", i, roles + x, (*kept, ("I", None))))
        if i < n:
            initial, fault = rows[2 * i], rows[2 * i + 1]
            late = fault == "t"
            heappush(heap, (cost + 3, audit + "D", i + 1, roles, kept))
            if fault != "d":
                heappush(heap, (cost + late, audit + "K", i + 1, roles + initial, (*kept, ("K", i))))
                for x in "ua":
                    heappush(heap, (cost + 2 + late, audit + "R", i + 1, roles + x, (*kept, ("R", i))))
    return min(ends)


def test_weights_give_the_cheapest_and_least_audit():
    rng = random.Random(1)
    shapes = {"".join(rng.choice("suua-") + rng.choice("...dt") for _ in range(rng.randint(0, 4))) for _ in range(500)}
    for rows in shapes:
        assert repair(rows) == cheapest(rows)[:2]
        assert len(repair(rows)[1]) <= longest_audit(len(rows) // 2)
    assert repair("") == (0, "") and repair("s.") == (3, "D") and repair("u.a.") == (0, "KK")


def test_a_long_conversation():
    rng = random.Random(2)
    rows = "".join(rng.choice("sua") + rng.choice("...dt") for _ in range(1_500))
    cost, audit = repair(rows)
    assert sum(a != "I" for a in audit) == 1_500
    late = sum(rows[2 * i + 1] == "t" for i, a in enumerate(a for a in audit if a != "I") if a != "D")
    assert cost == 3 * audit.count("D") + 2 * (audit.count("I") + audit.count("R")) + late


def blank(text):
    return not re.search(r"[^\x20\x09-\x0D]", text)


def brute(rows):
    """Contract on rows (conv_id, turn, role, text) after damage; ties of a turn by role, then digest."""
    by_conversation = {}
    for r in rows:
        by_conversation.setdefault(r[0], [])
        if not r[4]:
            by_conversation[r[0]].append(r[1:4])
    out = []
    for c, held in by_conversation.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        codes, seen, counts, illegal = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}, 0
        for k, (_, role, text) in enumerate(held):
            fault = None
            if blank(text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text).group(1) not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            illegal += k > 0 and held[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
            codes += (role[:1] if role[:1] in ("s", "u", "a") else "-") + {"truncated": "t", None: "."}.get(fault, "d")
        cost, audit, roles, kept = cheapest(codes)
        named = {"u": "user", "a": "assistant"}
        lines = []
        for initial, (edit, i) in zip(roles, kept):
            lines.append(named[initial] + ":" if edit == "I" else f"{held[i][1] if edit == 'K' else named[initial]}:{held[i][2]}")
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def hurt(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, turn, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    return out


def talk(rng, n):
    texts = ["Hello there.", "What? ", "no end", "yes!\n", "", " \t", "é.", "a.\x0b", None, "so...", "x\xa0"]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 5)):
            rows.append((c, t * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)))
    return rows


def run(spark, rows, extra=()):
    schema = "conv_id long, turn long, role string, text string" + "".join(f", {c} string" for c in extra)
    df = spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], schema).repartition(3)
    return damaged(df)


def test_against_brute_force(spark):
    rows = talk(random.Random(5), 150) + [(900, None, "user", "a."), (900, None, "user", "b"), (900, 1, "assistant", "c."),
                                          (None, 1, "user", "no id."), (None, 2, "assistant", "x."), (-3, -2, "system", "s."), (-3, 4, "user", "u.")]
    hurt_rows = run(spark, rows, ["digest", "kind", "with_text"])
    assert sorted(map(tuple, hurt_rows.collect()), key=repr) == sorted(hurt(rows), key=repr)
    got = sorted(map(tuple, repaired(hurt_rows).collect()), key=repr)
    assert got == brute(hurt(rows))


def test_a_conversation_without_rows_and_an_empty_table(spark):
    gone = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repaired(run(spark, [(gone, 0, "user", "x.")])).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repaired(run(spark, [])).collect() == []


def test_plain_rows_and_very_long_texts(spark, long_text):
    """The operator without the damage: null role and text are empty."""
    rows = [(1, 0, "user", long_text + "."), (1, 1, "assistant", long_text + "."), (2, 0, None, None), (2, 1, "user", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in repaired(df).collect()}
    assert got[1].audit == "KK" and got[1].repaired_sha256 == hashlib.sha256(
        f"user:{long_text}.\nassistant:{long_text}.".encode()).hexdigest()
    assert (got[2].blank, got[2].illegal, got[2].cost, got[2].audit) == (1, 1, 5, "DKI")
