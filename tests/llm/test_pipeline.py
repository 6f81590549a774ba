"""The corpus pipeline, each stage against brute force on its own input."""

import random
import string
import time
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from test_dedup import brute_decontaminate, brute_lines, brute_near
from test_tokens import check_packing

from parcelyard.llm import line_dedup
from parcelyard.llm.common import keep, keep_alone, table
from parcelyard.llm.encoding import WORDS

CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Labels of the scratch tables that the frame of a stage reads.
BEHIND = {"language": [], "lines": ["line-masks"], "near-duplicates": ["chosen"], "decontamination": ["contaminated"]}


def test_each_stage_on_what_its_predecessor_kept(spark, sf):
    docs = table(spark, sf, "documents").limit(70)
    extra = spark.createDataFrame([(None, "no letters? yes", "en", "s", 3), (1, None, "en", "s", 0), (2, "", "en", "s", 0),
                                   (3, "123 456", "fr", "s", 7)], docs.schema)
    docs = keep(docs.unionByName(extra), "docs")
    texts = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    steps = dict(corpus_pipeline.STAGES)
    assert [*steps] == ["language", "lines", "near-duplicates", "decontamination", "packing"]

    known = keep(steps["language"](spark, docs, sf), "language")
    assert known.columns == docs.columns
    assert Counter(texts(known)) == Counter((i, t) for i, t in texts(docs) if any(c.isalpha() for c in t or ""))

    lines = keep(steps["lines"](spark, known, sf), "lines")
    assert lines.columns == docs.columns
    want = brute_lines(texts(known), line_dedup.MIN_CHARS)
    assert set(r["doc_id"] for r in lines.collect()) <= {k[0] for k in want}
    same = {k[0] for k in want if k[2] == 0}
    assert Counter((i, t) for i, t in texts(lines) if i in same) == Counter((i, t) for i, t in texts(known) if i in same)

    near = keep(steps["near-duplicates"](spark, lines, sf), "near")
    groups = {k[2] for k in brute_near(texts(lines), 5, 80) if k[1]}
    assert near.columns == docs.columns and Counter(i for i, t in texts(near) if t.strip()) == Counter(groups)

    clean = keep(steps["decontamination"](spark, near, sf), "clean")
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    found = brute_decontaminate(texts(near), items, 10)
    assert clean.columns == docs.columns
    assert Counter(i for i, _ in texts(clean)) == Counter(k[0] for k, n in found.items() if not k[-1] for _ in range(n))

    assert check_packing(steps["packing"](spark, clean, sf).collect(), texts(clean), 1024)


def test_stages_leave_columns_with_their_own_names_alone(spark, sf, hard):
    docs = keep(hard, "hard")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = keep(stage(spark, docs, sf), "out")
        assert out.columns == docs.columns, name
        fixed = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        assert all(set(r) == {"x"} for r in out.select(*[f"`{c}`" for c in fixed]).collect()), name
        assert 0 < out.count() <= docs.count()
        docs = out


def test_stages_of_an_empty_table_of_repeats_and_of_long_texts(spark, sf, documents):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, long), (2, long), (2, long), (None, "one and two"), (None, "three or four")]
    for docs, least in ((documents(rows[:1]).limit(0), 0), (documents(rows), 1)):
        docs = keep(docs, "docs")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = keep(stage(spark, docs, sf), "stage")
            assert docs.count() >= least, name
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
        left = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert bool(check_packing(pieces, left, 1024)) == bool(left) == bool(least)


def test_packing_remembers_fewer_words_than_a_query_alone(spark, monkeypatch):
    given = []
    monkeypatch.setattr(corpus_pipeline.packing, "pack_documents", lambda docs, words: given.append(words) or docs)
    dict(corpus_pipeline.STAGES)["packing"](spark, None, "")
    assert given[0] * 10 <= WORDS


def test_stages_leave_only_the_tables_behind_what_they_return(spark, sf):
    docs = keep(table(spark, sf, "documents").limit(60), "docs")
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = set(scratch.iterdir())
        out = stage(spark, docs, sf)
        labels = sorted(path.name.rsplit("-", 1)[0] for path in set(scratch.iterdir()) - before)
        assert labels == BEHIND[name], name
        docs = keep(out, "stage")


def test_keep_alone_deletes_what_was_kept_on_the_way_and_no_more(spark):
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    labels = lambda: sorted(path.name.rsplit("-", 1)[0] for path in set(scratch.iterdir()) - before)
    before = set(scratch.iterdir())
    outside = keep(spark.range(3), "outside")

    def inner():
        return keep(keep(spark.range(5), "first"), "second")

    def outer():
        found = keep_alone(inner, "inner")
        assert labels() == ["inner", "outside"]
        return found.join(outside, "id")

    assert sorted(r[0] for r in keep_alone(outer, "outer").collect()) == [0, 1, 2]
    assert labels() == ["outer", "outside"]

    def fails():
        keep(spark.range(5), "lost")
        raise LookupError

    with pytest.raises(LookupError):
        keep_alone(fails, "none")
    keep(spark.range(1), "later")
    assert labels() == ["later", "outer", "outside"] and outside.count() == 3


def shuffled(spark):
    """The shuffle files that lie on disk: their names and bytes."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}


def test_a_stored_table_leaves_nothing_shuffled_on_disk(spark):
    setting, before = spark.conf.get(CLEANED), set(shuffled(spark))
    counts = keep(spark.range(20_000).selectExpr("id % 700 as k").groupBy("k").count().repartition(5, "count"), "counts")
    for _ in range(50):  # Spark deletes in the background
        if not (left := set(shuffled(spark)) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(CLEANED) == setting
    assert counts.count() == 700


def test_lines_shuffles_each_text_once(spark, documents):
    draw = random.Random(5)
    letters = string.ascii_letters + string.digits  # hardly compressed
    line = lambda: "".join(draw.choices(letters, k=1000))
    # Texts longer than what the compression of a shuffle looks back over; all share a line.
    docs = keep(documents([(k, "\n".join(["a line of all texts", *(line() for _ in range(80))])) for k in range(20)]), "docs")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dict(corpus_pipeline.STAGES)["lines"](spark, docs, "")
        before = set(shuffled(spark))
        assert sum(r["text"].startswith("a line of all texts\n") for r in out.collect()) == 1
        moved = sum(size for name, size in shuffled(spark).items() if name not in before)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    texts = sum(len(r["text"]) for r in docs.collect())
    assert 0.5 * texts < moved < 1.3 * texts
