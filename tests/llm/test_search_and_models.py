"""Top-k, archives, language and severity against plain computations."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from oracle_check import connect, difference

from parcelyard.llm import langid, queries, topk, toxicity, warc
from parcelyard.llm.common import table


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, sf, name):
    assert difference(connect(sf), queries.ORACLES[name], queries.QUERIES[name](spark, sf)) is None


VECTORS = "vec_id long, embedding array<float>, block string, score string"


def brute_top(rows, k, asked):
    """Rows that take part, compared one by one."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [(i, [math.floor(64 * x) for x in np.array(v, np.float32).astype(float)]) for i, v in rows]
    out = Counter()
    for at, (i, v) in enumerate(whole):
        if i is None or not asked(i):
            continue
        found = [(-sum(a * b for a, b in zip(v, w)), j) for n, (j, w) in enumerate(whole) if n != at]
        found.sort(key=lambda s: (s[0], s[1] is None, s[1] or 0))
        out.update((i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], 1))
    return out


def test_top_k_hard_rows(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(150)]
    rows += [(150 + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(3, rows[3][1])] * 2 + [(None, rows[5][1]), (500, None), (501, [1.0, None]), (502, [float("nan")] * 6)]
    rows += [(503, [float("inf")] * 6), (505, []), (510, [0.0] * 6), (515, [2.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    monkeypatch.setattr(topk, "RESCORED", 2)
    for blocks in (10_000, 40):
        got = topk.top_k(df, 4, topk.F.col("vec_id") % 5 == 0, block_rows=blocks).collect()
        assert Counter(tuple(r) for r in got) == brute_top(rows, 4, lambda i: i % 5 == 0)
    assert topk.top_k(df.limit(0), 4, topk.F.col("vec_id") % 5 == 0).collect() == []


def test_levels_stop_on_proof_only():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-60, 60, (4000, 16))
    vectors[::7] = 0
    asked = vectors[:50] * 3
    block, own = topk.ImpactBlock(vectors), np.arange(50)
    sizes = {q: len(places) for q, places, _ in block.search(asked, own, 5)}
    assert all(5 <= n <= topk.RESCORED * 5 for q, n in sizes.items() if q % 7) and len(sizes) == 50
    for q, places, found in block.top(asked, own, np.arange(4000), 5):
        full = vectors @ asked[q]
        full[q] = -(10**9)
        want = sorted(range(4000), key=lambda j: (-full[j], j))[:5]
        assert places.tolist() == want and found.tolist() == full[want].tolist()


PAGES = "page_id long, url string, html string, digest string, size long"


def test_archives_hard_rows(spark):
    body = "x" * 1200
    rows = [(1, "http://www.b.example.com:80/p?q=1#f", body), (2, "https://a.example.com/é ü", body), (2, None, body),
            (3, "not a url", None), (4, "", ""), (5, "http://[bad", "é" * 600), (6, "http://x.org/\r\nWARC-Type: no", "é" * 600),
            (None, "http://x.org/", body), (7, "http://x.org/", "short"), (8, "http://x.org/", "short"), (9, "u", "l" * 300_000)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    got = Counter(tuple(r) for r in warc.round_trip(pages).collect())
    largest = defaultdict(int)
    for page, _, html in rows:
        largest[html] = max(largest[html], page or 0)
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and page != largest[html]
        want[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", largest[html] if again else None)] += 1
    assert got == want
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_look_up_reads_only_what_it_needs(spark, sf):
    pages = table(spark, sf, "pages")
    index, captures = warc.archive(pages)
    small = warc.build_index(captures, index.parts[0][1].rsplit("/", 2)[0] + "/small", block_lines=3)
    urls = [r["url"] for r in pages.select("url").distinct().collect()]
    asked = spark.createDataFrame([(u,) for u in [*urls, "http://nowhere.example/"]], "url string")
    found = warc.look_up(asked, small).collect()
    want = Counter()
    for r in pages.collect():
        for u in urls:
            if warc.url_key(u) == warc.url_key(r["url"]):
                want[(u, r["page_id"])] += 1
    assert Counter((r["url"], r["page_id"]) for r in found) == want
    part = warc.IndexPart(small.parts[0][1], small.parts[0][2])
    keys = [line[0] for line in part.lines()]
    assert keys == sorted(keys) and all(len(part.block(k)) <= 3 for k in range(len(part.directory)))


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/a?b#c") == warc.url_key("https://example.com/a?b") == "com,example)/a?b"
    assert warc.url_key("http://example.com:8080") == "com,example:8080)/"


def brute_language(model, text):
    """The definition: words, then the longest n with a known n-gram."""
    words = regex.findall(r"\p{L}+", (text or "").lower())
    if not words or not model.languages:
        return langid.UNKNOWN
    total, said = np.zeros(len(model.languages)), 0
    for word in words:
        if word in model.words:
            total, said = total + model.weights[model.words[word]], said + 1
            continue
        for size, known in zip(range(langid.LONGEST_GRAM, 0, -1), model.grams):
            padded = f"<{word}>"
            grams = [padded[k : k + size] for k in range(len(padded) - size + 1)]
            rows = [known[g] for g in grams if g in known and g not in ("<", ">")]
            if rows:
                total, said = total + model.weights[rows].mean(axis=0), said + 1
                break
    return model.languages[int((total / max(1, said) ** 0.5).argmax())]


def test_language_is_learned_and_held_out(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.filter(langid.learnable()))
    texts = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    rows = queries.op5_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        assert r["lang_pred"] == brute_language(model, texts[r["doc_id"]][0])
    held = [r["lang_pred"] == texts[r["doc_id"]][1] for r in rows if r["held_out"]]
    assert sum(held) > 0.95 * len(held)


def test_language_hard_rows(spark, documents, hard):
    one, two = [i for i in range(20, 40) if zlib.crc32(str(i).encode()) % 3 != 1][:2]  # ids that may be learned from
    docs = documents([(one, "the cat and the dog", "en"), (two, "le chat et le chien", "fr"), (4, "xx", None), (5, "123 --", "en"),
                      (6, None, "fr"), (7, "", "en"), (None, "le chat", "fr"), (8, "chats", None), (8, "chats", None)])
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert {i: got[i]["lang_pred"] for i in (5, 6, 7)} == dict.fromkeys((5, 6, 7), "und")
    assert got[8]["lang_pred"] == "fr" and got[None]["held_out"] is False
    assert langid.identify(docs).count() == 9
    assert langid.identify(docs.limit(0)).collect() == []
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", langid.F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(hard).count() == hard.count()
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted(["the cat and the dog", "le chat et le chien", "xx", "le chat", "chats", "chats"])


def test_language_stage_keeps_letters_without_a_model(spark, documents):
    rows = [(1, "the cat"), (2, "日本語の文"), (None, "le chat"), (3, "123 --"), (4, None), (5, ""), (1, "the cat")]
    letters = ["the cat", "the cat", "日本語の文", "le chat"]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    unlabelled = documents([(i, t, None) for i, t in rows])
    held_only = documents([(held[k], t, "en") for k, (_, t) in enumerate(rows)])
    for docs in (unlabelled, held_only):
        kept = langid.keep_identified(docs)
        assert kept.columns == docs.columns and sorted(r["text"] for r in kept.collect()) == sorted(letters)


def test_text_without_known_pieces_stays(spark, documents):
    one, two = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    docs = documents([(one, "the cat", "en"), (two, "le chat", "fr"), (None, "日本語の文", None)])
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert got[None]["lang_pred"] == "en" and got[None]["score"] == 0.5
    assert langid.keep_identified(docs).count() == 3


def test_number_signs_are_no_letters(spark, documents):
    one, two = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    signs = ["²", "½ ① Ⅳ", "m²", "Ⅳcat²dog", "٣", "cat²"]
    docs = documents([(one, "the cat and the dog", "en"), (two, "le chat", "fr"), *[(100 + k, t, None) for k, t in enumerate(signs)]])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert [got[100 + k] for k in range(6)] == ["und", "und", got[102], "en", "und", "en"] and got[102] != "und"
    assert langid.words_of("Ⅳcat²dog m² É_x9y") == ["cat", "dog", "m", "é", "x", "y"]
    assert sorted(r["text"] for r in langid.keep_identified(docs).collect() if r["doc_id"] >= 100) == sorted(["m²", "Ⅳcat²dog", "cat²"])


def test_bounds_of_the_model_hold(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, documents=10**9, words=100, grams=50)
    assert len(model.words) <= 100 * len(model.languages)
    assert all(len(known) <= 50 * len(model.languages) for known in model.grams)


def test_bound_is_filled_within_a_count(spark, monkeypatch):
    rows = [("a", f"w{k}", 1 + (k < 5)) for k in range(300)] + [("b", f"é{k}", 3) for k in range(50)] + [("c", "x", 1)]
    df = spark.createDataFrame(rows, "lang string, item string, n long")
    for slots in (4096, 1):
        monkeypatch.setattr(langid, "SLOTS", slots)
        got = langid._frequent(df, ["lang"], 40).collect()
        assert Counter(r["lang"] for r in got) == {"a": 40, "b": 40, "c": 1}
        assert {r["item"] for r in got if r["lang"] == "a"} >= {f"w{k}" for k in range(5)}
    assert {r["item"] for r in got if r["lang"] == "b"} == set(sorted(f"é{k}" for k in range(50))[:40])


def test_severity_learns_ordered_grades():
    rng = random.Random(3)
    texts, grades = [], []
    for _ in range(900):
        words = [f"w{rng.randrange(300)}" for _ in range(30)]
        grade = rng.randrange(3)
        words += rng.sample(["mean", "rude"], 1) * (grade >= 1) + ["vile"] * (grade == 2)
        texts.append(" ".join(words))
        grades.append(grade)
    model = toxicity.fit_weights(texts, np.array(grades))
    assert model.thresholds[0] < model.thresholds[1]
    assert model.words["vile"] > 1 < model.words["rude"]
    plain = sum(model.words.get(w, 0) for w in toxicity.features("w1 w2 w3"))
    assert plain < model.thresholds[0] < plain + model.words["mean"] < model.thresholds[1]
    assert toxicity.fit_weights(["a"], np.array([1])).thresholds == ()


def test_severity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    grades = labels.select("doc_id", toxicity.grade().alias("grade"))
    english = docs.filter("lang = 'en'")
    even = toxicity.F.pmod(toxicity.F.xxhash64("doc_id"), toxicity.F.lit(2)) == 0
    model = toxicity.fit(english, grades.filter(even))
    found = toxicity.predict(english, model).join(labels.filter(~even).select("doc_id", labels.toxic.alias("true")), "doc_id").collect()
    caught = [r["toxic"] for r in found if r["true"] == 1]
    spared = [not r["toxic"] for r in found if r["true"] == 0]
    assert sum(caught) > 0.8 * len(caught) and sum(spared) > 0.99 * len(spared)
    assert all(0 <= r["severity"] <= 2 and 0 <= r["toxic_score"] <= 1 for r in found)


def test_severity_hard_rows(spark, hard):
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 1), (3, 0, 1), (4, 1, 0), (None, 1, 1), (5, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    grades = labels.select("doc_id", toxicity.grade().alias("grade"))
    for some in (grades, grades.limit(0), grades.filter("doc_id = 4")):
        got = toxicity.predict(hard, toxicity.fit(hard, some)).collect()
        assert len(got) == hard.count() and all(r["severity"] is not None for r in got)
    assert toxicity.predict(hard.limit(0), toxicity.fit(hard, grades)).collect() == []


def test_a_language_model_is_not_fetched_as_rows(spark, monkeypatch):
    """Its words and n-grams reach the driver as columns; rows of them took most of the driver's Python memory."""
    from parcelyard.llm import langid

    docs = spark.range(2_000).selectExpr(
        "concat('same ', translate(string(id), '0123456789', 'abcdefghij'), if(id % 2 = 0, ' le', ' the')) as text", "if(id % 2 = 0, 'fr', 'en') as lang"
    )
    frame, fetched = type(docs), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    model = langid.fit(docs)
    assert len(model.words) == 2_003 and max(map(len, fetched)) < 100
    assert model.weights.shape == (2_003 + sum(map(len, model.grams)), 2) and model.weights.dtype == "float32"
    rows = spark.createDataFrame([("le le",), ("the the",), (None,), ("12",)], "text string")
    assert [r[0]["lang_pred"] for r in rows.select(langid.language(rows, model)).collect()] == ["fr", "en", "und", "und"]
