"""Benchmark decontamination with a distributed positional inverted index (operator 6). Spark SQL functions only.

A window is ``WINDOW`` consecutive words of a benchmark item (an item with fewer words is one window). The words of the corpus are
cut once and stored, and counted for each benchmark word; every window is then known by its two rarest words. The index
stores the postings (document, position) of those words. The list of a window's rarest word, moved back by the
word's offset, gives the possible starts; it is intersected with the moved list of the next rarest word, and what is
left is compared word by word with the document. A frequent word thus meets only the few windows that have nothing
rarer. Matches are reported per document and window.

Defined cases: NULL and empty texts have no words and no hits; items without words match nothing; equal windows of
several items are searched once; rows equal in id and text share their result; a NULL item id is left out of the
items but its windows count as hits; empty tables give empty results or no hits.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import free_names, keep, keep_alone, row_key
from parcelyard.operators.staging import broadcast_if_small

WINDOW = 10
# Fixed value: what stands between words, after A-Z became a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERM_BYTES = 200  # generous size in memory of a word with its numbers
KEY = ["row_id", "row_hash"]


def words(text: str = "text") -> Column:
    """Words of a text; NULL text has none. Only A-Z are lower-cased."""
    col = F.coalesce(F.col(text), F.lit(""))
    plain = F.octet_length(col) == F.char_length(col)
    small = F.when(plain, F.lower(col)).otherwise(F.translate(col, string.ascii_uppercase, string.ascii_lowercase))
    # Only the ends of the split can be empty.
    return F.array_remove(F.split(small, BETWEEN), "")


def tokenized(docs: DataFrame) -> DataFrame:
    """Every row's keys, doc_id and words ``w``, cut once and stored; all passes read this table."""
    return keep(docs.select(*row_key(), F.col("doc_id").cast("long"), words().alias("w")), "words")


def item_windows(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, terms) and which item has which (window_id, item_id)."""
    cut = items.select("item_id", words().alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    each = cut.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at"), size).alias("terms"))
    # Words hold no blanks, so the joined words identify a window.
    named = keep(each.withColumn("window_id", F.md5(F.concat_ws(" ", "terms"))).distinct(), "windows")
    return named.select("window_id", "terms").distinct(), named.select("window_id", "item_id").filter("item_id is not null")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a stored table of words if its size allows."""
    return broadcast_if_small(df, df.count() * TERM_BYTES)


def term_counts(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Occurrences in the corpus of each ``term`` of the vocabulary that occurs at all."""
    seen = tokens.select(F.explode("w").alias("term")).join(_small(vocabulary), "term", "left_semi")
    return seen.groupBy("term").agg(F.count("*").alias("n"))


def postings(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The positional index: row_id, row_hash, term, pos (from 0) of the words in the vocabulary."""
    placed = tokens.select(*KEY, F.posexplode("w").alias("pos", "term"))
    return placed.join(_small(vocabulary), "term", "left_semi").select(*KEY, "term", "pos")


def ranked_windows(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows all of whose words occur in the corpus, with ``rarest``: (n, offset, term) from the rarest up."""
    terms = windows.select("window_id", F.posexplode("terms").alias("offset", "term"))
    joined = terms.join(_small(counts), "term", "left")
    ranked = joined.groupBy("window_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("rarest"), F.count("n").alias("known")
    )
    return windows.join(ranked, "window_id").filter(F.col("known") == F.size("terms")).drop("known")


def phrase_matches(tokens: DataFrame, windows: DataFrame) -> DataFrame:
    """Every occurrence of a window: row_id, row_hash, and ``found``, an array of (start, size, window_id)."""
    vocabulary = keep(windows.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    counts = keep(term_counts(tokens, vocabulary), "term-counts")
    # The rarest word, and the rarest other one; a window of one repeated word has only the first.
    ranked = ranked_windows(windows, counts)
    other = F.filter("rarest", lambda x: x["term"] != F.col("rarest")[0]["term"])
    chosen = keep(
        ranked.select(
            "window_id", "terms", F.col("rarest")[0]["term"].alias("term"), F.col("rarest")[0]["offset"].alias("offset"),
            F.get(other, F.lit(0))["term"].alias("next_term"), F.get(other, F.lit(0))["offset"].alias("next_offset"),
        ),
        "chosen",
    )
    needed = keep(
        chosen.select(F.explode(F.array("term", "next_term")).alias("term")).filter("term is not null").distinct(), "needed"
    )
    index = keep(postings(tokens, needed), "postings")
    narrow = _small(chosen.select("window_id", "term", "offset", "next_term", "next_offset"))
    starts = (
        index.join(narrow, "term").withColumn("start", F.col("pos") - F.col("offset")).filter("start >= 0")
        .select(*KEY, "window_id", "start", "next_term", (F.col("start") + F.col("next_offset")).alias("next_pos"))
    )
    nexts = index.select(*KEY, F.col("term").alias("next_term"), F.col("pos").alias("next_pos"))
    both = starts.filter("next_term is not null").join(nexts, [*KEY, "next_term", "next_pos"], "left_semi")
    left = both.unionByName(starts.filter("next_term is null")).select(*KEY, "window_id", "start").distinct()
    listed = keep(
        left.join(_small(chosen.select("window_id", "terms")), "window_id")
        .groupBy(*KEY).agg(F.collect_list(F.struct("start", "terms", "window_id")).alias("possible")),
        "possible",
    )
    # Only documents with possible starts are moved to them.
    holders = _small(listed.select(*KEY))
    texts = tokens.select(*KEY, "w").join(holders, KEY, "left_semi").join(listed, KEY)
    same = F.filter("possible", lambda p: F.slice("w", p["start"] + 1, F.size(p["terms"])) == p["terms"])
    found = F.transform(same, lambda p: F.struct(p["start"], F.size(p["terms"]).alias("size"), p["window_id"].alias("window_id")))
    return texts.select(*KEY, found.alias("found")).filter(F.size("found") > 0).dropDuplicates(KEY)


def proximity_matches(tokens: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """Places where all distinct words of a window lie within ``slop`` words of its rarest one, in any order.

    Returns row_id, row_hash, window_id, pos (of the rarest word). Postings meet within blocks of ``slop``
    positions, so a frequent word in a long document isn't paired with all of its occurrences.
    """
    vocabulary = keep(windows.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    ranked = keep(ranked_windows(windows, keep(term_counts(tokens, vocabulary), "term-counts")), "ranked")
    index = keep(postings(tokens, vocabulary).distinct(), "postings")
    anchors = index.join(_small(ranked.select("window_id", F.col("rarest")[0]["term"].alias("term"))), "term")
    block = F.floor(F.col("pos") / (slop + 1))
    wanted = anchors.join(_small(ranked.select("window_id", F.array_distinct("terms").alias("all"))), "window_id").select(
        *KEY, "window_id", "pos", F.size("all").alias("n"), F.explode("all").alias("term"), block.alias("block")
    )
    near = wanted.withColumn("block", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)))
    there = index.select(*KEY, "term", F.col("pos").alias("at"), F.floor(F.col("pos") / (slop + 1)).alias("block"))
    met = near.join(there, [*KEY, "term", "block"]).filter(F.abs(F.col("pos") - F.col("at")) <= slop)
    terms = met.select(*KEY, "window_id", "pos", "n", "term").distinct().groupBy(*KEY, "window_id", "pos", "n").count()
    return terms.filter(F.col("count") == F.col("n")).select(*KEY, "window_id", "pos")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: row_id, row_hash, doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows, owners = item_windows(items, size)
    tokens = tokenized(docs)
    matches = keep_alone(lambda: phrase_matches(tokens, windows), "matches")
    places = F.flatten(F.transform("found", lambda f: F.sequence(f["start"], f["start"] + f["size"] - 1)))
    hits = matches.select(*KEY, F.size(F.array_distinct(places)).cast("long").alias("n_hit"))
    ids = (
        matches.select(*KEY, F.explode(F.array_distinct("found.window_id")).alias("window_id")).join(owners, "window_id")
        .groupBy(*KEY).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    found = keep(hits.join(ids, KEY, "left"), "hits")
    counted = tokens.select(*KEY, "doc_id", F.size("w").cast("long").alias("n_words"))
    listed = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    return counted.join(found, KEY, "left").select(
        *KEY, "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Documents in which no window occurs. All columns stay as they are."""
    bad = keep_alone(lambda: phrase_matches(tokenized(docs), item_windows(items, size)[0]).select(*KEY), "contaminated")
    names = free_names(docs, *KEY)
    keyed = docs.withColumns(dict(zip(names, row_key())))
    bad = bad.select(*[F.col(k).alias(name) for k, name in zip(KEY, names)])
    return keyed.join(bad, names, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
