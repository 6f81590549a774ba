"""Conversation repair against a forward search over edit strings, and against all edit strings of small conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from parcelyard.llm import queries, turns
from parcelyard.llm.common import table

BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        if solid:
            seen.add((role, text))
    return out


def after(state, initial):
    """State of the pattern (s?(ua)+)? after another initial; None if there is none."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))


def cheapest(rows, found):
    """Least (cost, edits) for each state, row by row from the front, with the rows made so far."""
    best = {"": (0, "", ())}
    for n in range(len(rows) + 1):
        for _ in range(2):  # inserted rows
            for state, (cost, edits, made) in list(best.items()):
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if (to := after(state, initial)) is not None:
                        best[to] = min(best.get(to, (9**9,)), (cost + 3, edits + "I", (*made, f"{name}:")))
        if n == len(rows):
            return min(best[s] for s in ("", "a") if s in best)
        (_, role, text), fault, new = rows[n], found[n], {}
        for state, (cost, edits, made) in best.items():
            ways = [(state, cost + 4, "D", made)]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                ways += [(after(state, role[:1]), cost + extra, "K", (*made, f"{role}:{text}"))]
                ways += [(after(state, i), cost + extra + 3, "R", (*made, f"{name}:{text}")) for i, name in (("u", "user"), ("a", "assistant"))]
            for to, c, edit, lines in ways:
                if to is not None:
                    new[to] = min(new.get(to, (9**9,)), (c, edits + edit, lines))
        best = new


def brute(rows, original):
    """conv -> the columns of the report, by the definition."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv in original:
        mine = sorted(by_conv[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        found = faults(mine)
        known = [t for t, _, _ in mine if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, made = cheapest(mine, found)
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def told(report):
    rows = report.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_op12_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries.op12_conversation_repair(spark, sf_dir)) == brute(damage(rows), {r[0] for r in rows})


def pattern(letters):
    return re.fullmatch("(s?(ua)+)?", letters) is not None


def all_repairs(letters):
    """Every edit string with up to two inserted rows in a place, by enumeration."""
    best = (9**9, "")
    for edits in itertools.product("DKR", repeat=len(letters)):
        for inserts in itertools.product(("", "u", "a", "ua", "au"), repeat=len(letters) + 1):
            for new in itertools.product("ua", repeat=edits.count("R")):
                new, made, cost, audit = iter(new), "", 0, ""
                for place, letter in enumerate([*letters, None]):
                    made, cost, audit = made + inserts[place], cost + 3 * len(inserts[place]), audit + "I" * len(inserts[place])
                    if letter is None:
                        break
                    edit, initial = edits[place], letter.translate(turns._CLASS)
                    audit += edit
                    if edit == "D":
                        cost += 4
                        continue
                    if letter.isdigit():
                        cost = 9**9
                        break
                    made += initial if edit == "K" else next(new)
                    cost += 3 * (edit == "R") + 3 * letter.isupper()
                if cost < 9**9 and pattern(made):
                    best = min(best, (cost, audit))
    return best


def test_every_small_conversation():
    for n in range(4):
        for letters in itertools.product(turns.LETTERS if n < 3 else "suxU1", repeat=n):
            if n < 3 or random.Random("".join(letters)).random() < 0.3:
                audit, cost = turns.trace("".join(letters), turns.END, turns.NOTHING, True)
                assert (cost, audit) == all_repairs("".join(letters)), letters


def test_four_vectors_stand_for_all():
    rng = random.Random(12)
    for _ in range(300):
        letters = "".join(rng.choices(rng.choice([turns.LETTERS, "u", "xs", "0", "ua", "uaS"]), k=rng.randrange(1, 40)))
        end = rng.choices(turns.LETTERS, k=rng.randrange(6))
        vector = turns.sweep("".join(end), turns.END)[0]
        assert all(vector[i] <= vector[j] + turns.BOUND[i][j] for i in range(4) for j in range(4))
        ends = turns.speculate(letters)
        assert turns.relative(turns.rerun(ends, vector)) == turns.sweep(letters, vector)[0]
        if turns.converged(ends):
            assert turns.relative(ends[0]) == turns.sweep(letters, vector)[0]


CONVERSATION = "conv_id long, turn long, role string, text string, place long, conv string, number long"


def hard_conversations():
    rng = random.Random(5)
    rows = [(1, None, "user", "Hi."), (1, 0, None, "x"), (1, 0, "assistant", None), (1, 9, "", "Well."), (2, 5, "system", " \n")]
    rows += [(None, t, r, f"{t}.") for t, r in enumerate(["system", "user", "assistant", "user"])]
    rows += [(3, t, "user", f"Same {t % 3}.") for t in range(200)]  # later ones are duplicates
    rows += [(4, t, "user", f"Other {t}" + "." * (t % 5 > 0)) for t in range(201)]  # one role, nothing converges
    rows += [(5, t, "tool" if t % 2 else "system", f"Line {t}!") for t in range(150)]
    rows += [(6, t // 3, rng.choice(["system", "user", "assistant", "Ünknown"]), rng.choice(["A.", "b", "", "C?", "d\v"]) * (t % 7)) for t in range(400)]
    rows += [(7, t, ["user", "assistant"][t % 2], f"long {t} " + "é" * 30_000 + ".") for t in range(6)]
    rows += [(8, None, "user", "No turn.")] * 3 + [(9, -(2**62), "user", "a."), (9, 2**62, "user", "b.")]
    rows += [(c, t, rng.choice(["system", "user", "assistant"]), f"{c} {t}.") for c in range(100, 160) for t in rng.sample(range(9), 4)]
    return rows


@pytest.mark.parametrize("chunk", [3, 16, 8192])
def test_hard_rows(spark, chunk):
    rows = hard_conversations()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CONVERSATION).repartition(5)
    want = brute(rows, {r[0] for r in rows})
    done = turns.repair(df, chunk)
    assert told(turns.repair_report(df, df, chunk)) == want
    assert max(done.passes) <= 8 and (chunk > 3 or max(done.passes) > 2)  # doubling: of up to 67 chunks
    lines = defaultdict(list)
    for r in sorted(turns.repaired_rows(done).collect(), key=lambda r: (r["place"], r["nth"])):
        lines[int(r["conv"][1:]) if r["conv"] else None].append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in want} == {c: v[-1] for c, v in want.items()}
    harmed = turns.damaged(df)
    assert told(turns.repair_report(df, harmed, chunk)) == brute(damage(rows), {r[0] for r in rows})
    assert turns.repair_report(df.limit(0), df.limit(0), chunk).collect() == []
    empty = told(turns.repair_report(df, df.limit(0), chunk))
    assert set(empty.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())} and set(empty) == set(want)
