"""Language identification with word-first backoff (operator 5).

A model has log frequencies per language of words and of character n-grams of words (with marks for the ends of a
word). A known word scores with its own frequency. An unseen word falls back to the longest n at which any of
its n-grams is known and scores with their mean; a word without a known letter says nothing. A document's
scores are the sums over its words.

The model is fitted on at most about ``documents`` labelled documents per language, chosen by a hash, and keeps
at most ``words`` words and ``grams`` n-grams of each length per language, the most frequent ones; these bounds are
parameters and limit what is broadcast. Prediction covers every document and its whole text.

Defined cases: NULL text, or text without a letter (a digit or a number sign such as ² or Ⅳ is none), is ``und`` with score 0, and so is everything when there is
nothing to learn from; ties go to the language that sorts first; repeated rows count as often as they occur; rows
with a NULL language or id teach nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import discard, free_names, give_back, keep

UNKNOWN = "und"
LONGEST_GRAM = 5
SMOOTHING = 0.1
REMEMBERED = 60_000  # unseen words and what they say, about 20 MB a worker
SLOTS = 4096  # of the hash that divides items of one count
WORD = re.compile(r"[^\W\d_]+")  # letters, and number signs such as ² or Ⅳ, which words_of cuts out
LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L) of a text in lower case, the same that ``fit`` counts."""
    words = WORD.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    return [run for word in words for run in ((word,) if word.isalpha() else LETTERS.findall(word))]


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies: one row of ``weights`` per known word, then per known n-gram; a column per language."""

    languages: tuple[str, ...]
    words: dict[str, int]
    grams: tuple[dict[str, int], ...]  # by length, longest first
    weights: np.ndarray


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows that the contract allows to learn from: not held out, language known."""
    return F.coalesce(~held_out(doc_id), F.lit(False)) & F.col("lang").isNotNull()


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def _frequent(counted: DataFrame, by: list[str], most: int) -> DataFrame:
    """The ``most`` rows per ``by`` with the highest counts, all if there are fewer; ties by hash of the item, then item.

    The cut-off comes from the number of rows per count, which is small, and of the count that crosses the bound from
    the number of rows per slot of the hash and the items of one slot; no group meets in one task.
    """
    sizes: dict[tuple, list] = defaultdict(list)
    for r in counted.groupBy(*by, "n").count().collect():
        sizes[tuple(r[c] for c in by)].append((r["n"], r["count"]))
    crossing, spare = {}, {}
    for key, found in sizes.items():
        left = most
        for n, rows in sorted(found, reverse=True):
            if rows > left:
                crossing[key], spare[key] = n, left
                break
            left -= rows

    def of_key(values: dict[tuple, object], kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for key, value in values.items():
            same = F.lit(True)
            for c, part in zip(by, key):
                same = same & (F.col(c) == F.lit(part))
            out = F.when(same, F.lit(value)).otherwise(out)
        return out

    slot, bound = F.pmod(F.xxhash64("item"), F.lit(SLOTS)), of_key(crossing, "long")
    tied = counted.filter(F.col("n") == bound)
    slots: dict[tuple, list] = defaultdict(list)
    for r in tied.groupBy(*by, slot.alias("slot")).count().collect() if crossing else []:
        slots[tuple(r[c] for c in by)].append((r["slot"], r["count"]))
    last = {}
    for key, found in slots.items():
        for k, rows in sorted(found):
            if rows > spare[key]:
                last[key] = k
                break
            spare[key] -= rows
    edge = of_key(last, "long")
    items: dict[tuple, list] = defaultdict(list)
    for r in tied.filter(slot == edge).select(*by, "item").collect() if last else []:
        items[tuple(r[c] for c in by)].append(r["item"])
    # The first item that stays out: strings compare by their bytes, as in Spark.
    out = {key: sorted(found, key=str.encode)[spare[key]] for key, found in items.items()}
    stays = (slot < edge) | ((slot == edge) & (F.col("item") < of_key(out, "string")))
    return counted.filter(bound.isNull() | (F.col("n") > bound) | ((F.col("n") == bound) & stays))


def fit(docs: DataFrame, documents: int = 8_000, words: int = 40_000, grams: int = 20_000) -> LanguageModel:
    """Fit on labelled ``docs`` (text, lang)."""
    labelled = docs.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row per language
    languages = tuple(sorted(counts))
    if not languages:
        return LanguageModel((), {}, (), np.zeros((0, 0)))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, documents / n))).otherwise(share)
    chosen = labelled.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000)
    # Written tables instead of cached ones: what is used several times takes no memory of executors and survives them.
    seen = keep(
        chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("item"))
        .groupBy("lang", "item").agg(F.count("*").alias("n")),
        "words",
    )
    padded = F.concat(F.lit("<"), F.col("item"), F.lit(">"))
    tables = [(_frequent(seen, ["lang"], words), 0)]
    pieces = None
    for n in range(1, LONGEST_GRAM + 1):
        places = F.sequence(F.lit(1), F.greatest(F.char_length(padded) - (n - 1), F.lit(1)))
        cut = F.transform(places, lambda at, n=n: F.substring(padded, at, F.lit(n)))
        rows = seen.select("lang", F.lit(n).alias("size"), F.explode(cut).alias("item"), "n")
        pieces = rows if pieces is None else pieces.unionByName(rows)
    pieces = pieces.filter(F.char_length("item") == F.col("size")).groupBy("lang", "size", "item").agg(F.sum("n").alias("n"))
    pieces = keep(pieces, "n-grams")
    tables.append((_frequent(pieces, ["lang", "size"], grams), None))
    column = {lang: k for k, lang in enumerate(languages)}
    found: dict[int, pa.Table] = {}
    for table, size in tables:
        got = table.toArrow()  # bounded by the parameters; as columns, as an object for every row takes the driver many times more
        for n in range(1, LONGEST_GRAM + 1) if size is None else (size,):
            found[n] = got if size is not None else got.filter(pc.equal(got["size"], n))
    discard(seen)
    discard(pieces)
    index, blocks, before = {}, [], 0
    for size in (0, *range(LONGEST_GRAM, 0, -1)):
        items, langs = found[size]["item"].to_pylist(), found[size]["lang"].to_pylist()
        index[size] = {item: before + k for k, item in enumerate(sorted(set(items)))}
        block = np.zeros((len(index[size]), len(languages)))
        block[[index[size][item] - before for item in items], [column[lang] for lang in langs]] = found[size]["n"].to_numpy()
        blocks.append(np.log((block + SMOOTHING) / (block.sum(axis=0) + SMOOTHING * (len(block) + 1))).astype(np.float32))
        before += len(block)
    weights = np.concatenate(blocks)
    return LanguageModel(languages, index[0], tuple(index[n] for n in range(LONGEST_GRAM, 0, -1)), weights)


class Scorer:
    def __init__(self, model: LanguageModel):
        self.model = model
        self._unseen: dict[str, tuple[tuple[int, ...], float]] = {}

    def _back_off(self, word: str) -> tuple[tuple[int, ...], float]:
        found = self._unseen.get(word)
        if found is None:
            padded, rows = f"<{word}>", []
            for size, table in zip(range(LONGEST_GRAM, 0, -1), self.model.grams):
                grams = (padded[k : k + size] for k in range(len(padded) - size + 1))
                rows = [table[g] for g in grams if g in table and (size > 1 or g not in "<>")]
                if rows:
                    break
            found = tuple(rows), 1 / max(1, len(rows))
            if len(self._unseen) >= REMEMBERED:
                self._unseen.clear()
            self._unseen[word] = found
        return found

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = Counter(words_of(text)) if text else None
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        known, rows, shares, said = self.model.words, [], [], 0
        for word, n in words.items():
            row = known.get(word)
            if row is not None:
                rows.append(row)
                shares.append(n)
                said += n
            else:
                some, share = self._back_off(word)
                if some:
                    rows += some
                    shares += [n * share] * len(some)
                    said += n
        if not rows:
            total = np.zeros(len(self.model.languages))
        else:
            total = np.asarray(shares) @ self.model.weights[rows] / math.sqrt(said)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def language(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """Struct column (lang_pred, score) of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        try:
            for texts in batches:  # one text at a time: a batch of them as Python strings is larger than the model
                found = [scorer(text.as_py()) for text in texts]
                yield pa.StructArray.from_arrays(
                    [pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())],
                    ["lang_pred", "score"],
                )
        finally:
            del scorer
            give_back()

    return F.arrow_udf(predict, "lang_pred string, score double")(F.col(text))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.withColumn("found", language(rows, model))
    kept = F.coalesce(held_out(), F.lit(False)).alias("held_out")
    return rows.select("doc_id", kept, "found.lang_pred", "found.score")


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows that may be learned from and predict all rows."""
    return predict(docs, fit(docs.filter(learnable())))


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents with letters; the others (NULL, no letter) go. All columns stay as they are.

    Where there is nothing to learn from, every document with a letter stays. A text without any known word or n-gram
    is no evidence against it: it stays too, as the language that sorts first (score 1 / number of languages).
    """
    model = fit(docs.filter(learnable()))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    (found,) = free_names(docs, "found")
    rows = docs.withColumn(found, language(docs, model))
    return rows.filter(F.col(found)["lang_pred"] != UNKNOWN).select(*[F.col(f"`{c}`") for c in docs.columns])
