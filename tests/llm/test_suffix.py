"""Suffix sorting and removal of repeated passages against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelyard.llm import queries, suffix_dedup
from parcelyard.llm.common import table


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_is_that_of_sorting(text):
    assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(docs, length):
    seen, out = defaultdict(int), Counter()
    whole = [(i, (t or "").encode()) for i, t in docs]
    for _, data in whole:
        for k in range(len(data) - length + 1):
            seen[data[k : k + length]] += 1
    for i, data in whole:
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if seen[data[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[(i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_op3_matches_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    assert Counter(tuple(r) for r in queries.op3_suffix_dedup(spark, sf).collect()) == brute(docs, 400)


@pytest.mark.parametrize("limit", [1 << 16, 0])
def test_hard_rows(spark, documents, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", limit)
    rng = random.Random(6)
    parts = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 400))) for _ in range(25)]
    docs = [(rng.randrange(30), "".join(rng.choice(parts) for _ in range(rng.randrange(0, 6)))) for _ in range(60)]
    docs += [docs[0], docs[0], (None, parts[0] * 2), (1, None), (2, ""), (3, "a" * 700), (4, "ab" * 300)]
    df = documents(docs, "'x' as row").selectExpr("*", "'y' as spans")
    assert Counter(tuple(r) for r in suffix_dedup.remove_repeats(df, 100).collect()) == brute(docs, 100)
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def test_only_what_can_differ_around_a_shared_middle_is_sorted(monkeypatch):
    rng = random.Random(3)
    shared = bytes(rng.randrange(97, 123) for _ in range(600))
    sides = [bytes(rng.randrange(97, 123) for _ in range(30)) for _ in range(4)]
    contexts = [sides[0] + shared + sides[1], sides[2] + shared + sides[3]]
    # One run each: all starts whose anchor is the one of the text's middle.
    first, last, anchor = suffix_dedup.runs(contexts[0], 400)
    hottest = max(range(len(first)), key=lambda k: last[k] - first[k])
    cut = [contexts[0][first[hottest] : last[hottest] + 400]]
    first, last, other = suffix_dedup.runs(contexts[1], 400)
    cut += [contexts[1][f : t + 400] for f, t, a in zip(first, last, other) if a == anchor[hottest]]
    assert len(cut) == 2
    sorted_symbols, build = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text: sorted_symbols.append(len(text)) or build(text))
    found = suffix_dedup.repeated_around(cut, 400)
    for k, marks in enumerate(found):
        other = cut[1 - k]
        assert [bool(m) for m in marks] == [cut[k][i : i + 400] in other for i in range(len(cut[k]) - 399)]
    assert 0 < sum(sorted_symbols) < 400 < sum(map(len, cut))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=40), st.text("ab", max_size=40)), min_size=1, max_size=6))
def test_contexts_of_one_anchor_against_brute_force(sides):
    # The anchor is the only piece with an "x", so its strings are those around it.
    length, core = 100, b"x" * 64
    contexts = [(a.encode() + core + b.encode()) for a, b in sides]
    contexts = [c for c in contexts if len(c) >= length]
    least = [suffix_dedup.runs(c, length) for c in contexts]
    cut = [c[f : t + length] for c, (first, last, anchor) in zip(contexts, least) for f, t, a in zip(first, last, anchor) if a == least[0][2][0]]
    counts = Counter(c[i : i + length] for c in cut for i in range(len(c) - length + 1))
    for c, marks in zip(cut, suffix_dedup.repeated_around(cut, length)):
        assert [bool(m) for m in marks] == [counts[c[i : i + length]] > 1 for i in range(len(c) - length + 1)]


@pytest.mark.parametrize("limit", [1500, 400])
def test_cells_of_hot_anchors_are_dealt(spark, documents, monkeypatch, limit):
    kept, store = [], suffix_dedup.keep
    monkeypatch.setattr(suffix_dedup, "keep", lambda df, label: kept.append((label, store(df, label))) or kept[-1][1])
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", limit)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    word = lambda n: "".join(rng.choice("xyz") for _ in range(rng.randrange(n)))
    docs = [(k, word(60) + passage + word(60)) for k in range(40)]
    docs += [docs[0], (None, docs[1][1]), (50, word(9) + docs[2][1]), (51, None)]
    assert Counter(tuple(r) for r in suffix_dedup.remove_repeats(documents(docs), 100).collect()) == brute(docs, 100)
    tables = dict(kept)
    every = tables["cells"].count()
    assert every and tables["strings"].count() < 21 * every
