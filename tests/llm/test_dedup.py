"""Decontamination, near duplicates and line dedup against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest

from parcelyard.llm import decontaminate, line_dedup, near_dups, queries
from parcelyard.llm.common import keep, table

ITEMS = "item_id long, text string, term string, pos int"


def brute_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute_decontaminate(docs, items, size):
    out = Counter()
    windows = []
    for item, text in items:
        w = brute_words(text)
        n = min(size, len(w))
        windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    for doc, text in docs:
        w, hit, ids = brute_words(text), set(), set()
        for item, g in windows:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    ids.update([str(item)] if item is not None else [])
        joined = ",".join(sorted(ids))
        out[(doc, len(w), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))] += 1
    return out


def test_decontamination_hard_rows(spark, documents, hard):
    rng = random.Random(5)
    base = [f"w{rng.randrange(8)}" for _ in range(400)]
    docs = [(i, " ".join(base[i : i + 60])) for i in range(40)] + [(None, "a B c"), (7, "a b c"), (7, "a b c"), (41, None), (42, "")]
    docs += [(43, "É é a, b; c!"), (44, "the the the the"), (45, "a " * 5000)]
    items = [(1, " ".join(base[30:45])), (10, " ".join(base[35:47])), (2, "A, b. C"), (3, "the the"), (4, None), (5, "..."),
             (6, "é é"), (9, "A B C"), (None, " ".join(base[50:53])), (11, "never seen words here"), (12, "a")]
    asked = spark.createDataFrame([(*r, "x", 0) for r in items], ITEMS)
    df = documents(docs, "'x' as term").selectExpr("*", "'y' as found", "'z' as w")
    got = Counter(tuple(r[2:]) for r in decontaminate.decontaminate(df, asked, 4).collect())
    assert got == brute_decontaminate(docs, items, 4)
    assert decontaminate.decontaminate(df.limit(0), asked).collect() == []
    assert not any(r["contaminated"] for r in decontaminate.decontaminate(df, asked.limit(0)).collect())
    clean = decontaminate.keep_clean(df, asked, 4)
    want = [k[0] for k, n in brute_decontaminate(docs, items, 4).items() if not k[-1] for _ in range(n)]
    assert clean.columns == df.columns and sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in clean.collect())
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    got = Counter(tuple(r[2:]) for r in decontaminate.decontaminate(hard, asked, 4).collect())
    assert got == brute_decontaminate(rows, items, 4)


def test_proximity(spark, documents):
    docs = documents([(1, "x b c x x a"), (2, "a x x x x x x b c"), (3, "c b a")])
    items = spark.createDataFrame([(1, "a b c", "x", 0)], ITEMS)
    windows, _ = decontaminate.item_windows(items)
    found = decontaminate.proximity_matches(decontaminate.tokenized(docs), windows, 4)
    assert sorted(r["row_id"] for r in found.select("row_id").distinct().collect()) == [1, 3]


def brute_proximity(docs, items, size, slop):
    """Documents and windows: every word of the window within ``slop`` of one place of the word that is rarest in the corpus."""
    cut = [(doc, brute_words(text)) for doc, text in docs]
    counts = Counter(w for _, found in cut for w in found)
    windows = set()
    for _, text in items:
        w = brute_words(text)
        n = min(size, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    out = set()
    for window in windows:
        if not all(counts[t] for t in window):
            continue
        rarest = min((counts[t], k, t) for k, t in enumerate(window))[2]
        for doc, w in cut:
            for at, t in enumerate(w):
                if t == rarest and set(window) <= set(w[max(0, at - slop) : at + slop + 1]):
                    out.add((-(2**63) if doc is None else doc, " ".join(window), at))
    return out


def test_proximity_hard_rows(spark, documents):
    rng = random.Random(6)
    docs = [(i, " ".join(f"w{rng.randrange(12)}" for _ in range(60))) for i in range(30)]
    docs += [(None, "A, b c"), (40, None), (41, ""), (42, "c " * 300 + "b a"), (43, "the the é"), (44, "C b A c")]
    items = [(1, "a b c"), (2, "the the"), (3, "É é"), (4, None), (5, "..."), (6, "w1 w2 w3 w4"), (None, "w5 w5 w6"), (7, "never w1"), (8, "b")]
    asked = spark.createDataFrame([(*r, "x", 0) for r in items], ITEMS)
    windows, _ = decontaminate.item_windows(asked, 3)
    windows = keep(windows, "asked")
    for slop in (0, 4):
        found = decontaminate.proximity_matches(decontaminate.tokenized(documents(docs)), windows, slop).join(windows, "window_id")
        got = Counter((r["row_id"], " ".join(r["terms"]), r["pos"]) for r in found.collect())
        assert got == Counter(brute_proximity(docs, items, 3, slop))


def test_no_python_in_native_plans(spark, sf):
    for name in ("op6_decontamination", "op10_line_dedup"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def brute_near(docs, size, percent):
    """All pairs, by the definition."""
    sets = []
    for _, text in docs:
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        width = min(size, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    group = list(range(len(docs)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[top(a)] = top(b)
    least = defaultdict(list)
    for k, (doc, _) in enumerate(docs):
        least[top(k)].append(doc)
    out = Counter()
    for k, (doc, _) in enumerate(docs):
        first = min((d for d in least[top(k)] if d is not None), default=None)
        out[(doc, len(sets[k]), first, doc == first)] += 1
    return out


def near_rows():
    rng = random.Random(9)
    word = lambda: f"W{rng.randrange(5000)}"
    docs, common = [], [word() for _ in range(60)]
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(1, 80))]
        for _ in range(rng.randrange(1, 8)):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(len(text))] = word()
            docs.append((rng.randrange(10**6), " ".join(text)))
            base = text if rng.random() < 0.5 else base  # chains
    docs += [(2 * 10**6 + k, " ".join(common + [word() for _ in range(25)])) for k in range(40)]  # a common passage
    return docs


def test_op9_matches_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = Counter(tuple(r) for r in queries.op9_near_duplicates(spark, sf).collect())
    assert got == brute_near(docs, 2, 80)


@pytest.mark.parametrize("size,percent,few,rounds,crowd", [(2, 80, 2, 4, 16), (5, 80, 0, 4, 16), (2, 60, 0, 1, 1), (2, 80, 0, 0, 3)])
def test_near_duplicates_hard_rows(spark, documents, hard, monkeypatch, size, percent, few, rounds, crowd):
    monkeypatch.setattr(near_dups, "FEW", few)
    monkeypatch.setattr(near_dups, "ROUNDS", rounds)
    monkeypatch.setattr(near_dups, "CROWD", crowd)
    docs = near_rows() + [(None, "one two three"), (5, None), (6, ""), (7, " \n "), (8, "Same"), (9, "same"), (9, "same"), (10, "one TWO three")]
    df = documents(docs, "'x' as component_id")
    got = Counter(tuple(r[2:]) for r in near_dups.near_duplicates(df, size, percent).collect())
    want = brute_near(docs, size, percent)
    assert got == want
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    got = Counter(tuple(r[2:]) for r in near_dups.near_duplicates(hard, size, percent).collect())
    assert got == brute_near(rows, size, percent)
    assert near_dups.near_duplicates(df.limit(0), size, percent).collect() == []


@pytest.mark.parametrize("percent", [60, 80])
def test_rarest_shingles_lose_no_link_and_spare_a_shared_passage(spark, percent):
    rng = random.Random(11)
    passage = list(range(100, 160))
    found = [sorted(set(passage + rng.sample(range(1000, 10**6), 60))) for _ in range(120)]  # near 0.33
    found += [sorted(rng.sample(range(30), rng.randrange(1, 30))) for _ in range(60)]  # few shingles, all shared
    found += [sorted((set(f) - set(f[:k])) | {-k}) for f in found[:40] for k in (3, 9)]
    sets = spark.createDataFrame(list(enumerate(found)), "node long, found array<long>")
    labels = {i: i for i in range(len(found))} | {i: 0 for i in range(0, 120, 3)}
    nodes = spark.createDataFrame([(i, len(f), labels[i]) for i, f in enumerate(found)], "node long, n long, label long")
    got = near_dups.rare_pairs(near_dups.rarest(sets, nodes, percent), percent).collect()
    pairs = {(r["a"], r["b"]) for r in got}
    assert len(pairs) == len(got) and all(r["a"] < r["b"] for r in got)
    assert all((labels[r["a"]], labels[r["b"]]) == (r["label_a"], r["label_b"]) for r in got)
    for a, b in itertools.combinations(range(len(found)), 2):
        x, y = set(found[a]), set(found[b])
        if labels[a] != labels[b] and 100 * len(x & y) >= percent * len(x | y):
            assert (a, b) in pairs
    assert not any(a < 120 and b < 120 for a, b in pairs)


def test_one_of_each_group_stays(spark, documents):
    docs = near_rows() + [(8, "same text"), (8, "same text"), (9, "Same text"), (5, None), (6, ""), (6, "")]
    df = keep(documents(docs), "docs")
    kept = near_dups.keep_one(df)
    assert kept.columns == df.columns
    want = brute_near(docs, 5, 80)
    groups = {k[2] for k in want if k[1]}
    empty = sum(n for k, n in want.items() if not k[1])
    rows = kept.collect()
    assert len(rows) == len(groups) + empty and {r["doc_id"] for r in rows if (r["text"] or "").strip()} == groups


def test_unrelated_groups_with_one_id_all_stay(spark, documents):
    other = ["red owls fly over the old barn", "we sold nine boats last week", "cold soup is best in july", "his train left before dawn today"]
    docs = [(None, other[0]), (None, other[1]), (None, other[1]), (7, other[2]), (7, other[3]), (7, other[3]), (9, other[3].upper())]
    kept = near_dups.keep_one(keep(documents(docs), "docs")).collect()
    assert sorted(r["text"] for r in kept) == sorted(other)
    assert Counter(r["doc_id"] for r in kept) == {None: 2, 7: 2}


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, rng.randrange(1, 50)) for _ in range(80)] + [(200, 200), (300, 310), (310, 305)]
    got = {r["node"]: r["label"] for r in near_dups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and got[305] == got[310] == got[300] == 300
    assert all(got[b] == 0 for a, b in edges if a == 0)


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :]
    return a[k + 1 :] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1 :]


def brute_lines(docs, least):
    rank = lambda i: -(2**63) if i is None else i
    lines = [(rank(i), pos, line) for i, t in docs if t is not None for pos, line in enumerate(t.split("\n")) if len(line) >= least]
    first = {}
    for i, pos, line in lines:
        first[line] = min(first.get(line, (i, pos)), (i, pos))
    by_size = defaultdict(list)
    for line in first:
        by_size[len(line)].append(line)
    near = {a for a in first for n in (len(a) - 1, len(a), len(a) + 1) for b in by_size[n] if first[b] < first[a] and within_one(a, b)}
    out = Counter()
    for i, t in docs:
        parts = [] if t is None else t.split("\n")
        kept = [p for pos, p in enumerate(parts) if len(p) < least or (p not in near and first[p] >= (rank(i), pos))]
        out[(i, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    return out


def test_op10_matches_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = Counter(tuple(r) for r in queries.op10_line_dedup(spark, sf).collect())
    assert got == brute_lines(docs, line_dedup.MIN_CHARS)


def edited(rng, line):
    k = rng.randrange(len(line) + 1)
    kind = rng.randrange(3)
    return line[:k] + rng.choice("xyé") * (kind != 0) + line[k + (kind != 1) :]


def test_line_dedup_hard_rows(spark, documents, hard):
    rng = random.Random(8)
    lines = ["".join(rng.choice("ab é") for _ in range(rng.randrange(3, 60))) for _ in range(60)] + ["z" * 20, "a" * 17, "long " * 2000]
    docs = []
    for i in range(120):
        some = [rng.choice(lines) for _ in range(rng.randrange(0, 8))]
        some = [edited(rng, s) if rng.random() < 0.5 else s for s in some]
        some = [edited(rng, s) if rng.random() < 0.3 else s for s in some]
        docs.append((rng.randrange(100), "\n".join(some)))
    docs += [docs[3], docs[4], (None, "\n".join(lines[:3])), (50, None), (51, ""), (52, "\n\n"), (53, "a" * 16 + "\r\n" + "a" * 16)]
    df = documents(docs, "'x' as h1").selectExpr("*", "'y' as _x", "'z' as first")
    got = Counter(tuple(r) for r in line_dedup.digests(df).collect())
    assert got == brute_lines(docs, line_dedup.MIN_CHARS)
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    assert Counter(tuple(r) for r in line_dedup.digests(hard).collect()) == brute_lines(rows, line_dedup.MIN_CHARS)
    assert line_dedup.digests(df.limit(0)).collect() == []
    kept = line_dedup.keep_first_lines(df)
    assert kept.columns == df.columns
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept.collect())


def test_one_copy_of_a_line_stays_under_a_hot_id(spark, documents):
    line, near, long = "Accept all cookies now", "Accept all cookies mow", "Subscribe to our letter"
    docs = [(i, f"{line}\ntext number {'abcdefgh'[k]} {'qrstuvwx'[k] * 20}") for i in (None, 7) for k in range(8)]
    docs += [(7, near + "\nshort"), (7, long), (7, long), (7, long), (7, long + "\nshort"), (None, None), (None, None), (8, ""), (8, "")]
    df = keep(documents(docs, "'x' as place").selectExpr("*", "'y' as at"), "docs")
    kept = line_dedup.keep_first_lines(df, stored=True)
    assert kept.columns == df.columns
    left = Counter(part for r in kept.collect() for part in (r["text"] or "").split("\n"))
    # All NULL ids come before 7, and each further line stays once.
    assert left[line] == 1 and left[near] == 0 and left[long] == 1 and left["short"] == 2
    assert sum(part.startswith("text number") for part in left.elements()) == 8
    removed = Counter(r["n_removed"] for r in line_dedup.digests(df, stored=True).collect())
    assert sum(n * c for n, c in removed.items()) == 15 + 8 + 1 + 3
    distinct = [d for d in docs if d[0] == 7][:1] + [(20, line), (21, near), (22, long), (23, long), (24, "a\nb")]
    unique = keep(documents(distinct), "docs")
    got = Counter(tuple(r) for r in line_dedup.digests(unique, stored=True).collect())
    assert got == brute_lines(distinct, line_dedup.MIN_CHARS)


def test_workers_hold_no_hashes_between_tasks():
    def work(batches):
        near_dups.shingles("some words of a text", 2)
        assert near_dups._hashes
        yield from batches

    assert list(near_dups._forgetting(work)(iter([1]))) == [1] and not near_dups._hashes
