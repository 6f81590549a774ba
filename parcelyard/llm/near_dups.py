"""Near-duplicate documents by circulant MinHash, banding and exact verification (operator 9).

A document's set holds the hashes of its distinct word shingles. Two permutations of ``SPACE`` places make
all coordinates of its signature: the first scatters the shingles, the second, shifted circularly by k, gives the
k-th coordinate as the least value at the scattered places. Bands of ``ROWS`` coordinates are bucket keys. At a similarity
of 0.8, 32 bands of 6 rows miss a pair with probability 0.00006.

Documents with equal sets are one node from the start, so exact copies, however many, cost one row each. Candidates
are compared without making all pairs of a bucket: in a round, every node meets a few of the members drawn for its
buckets, of those not known to be in its component; verified links join components, and buckets whose nodes are all in one
component are done. After the rounds, all pairs of small mixed buckets that no round has compared are compared. A crowded
bucket, of documents that share a passage without being copies, is split further: its nodes meet at their rarest shingles, of which
any two linked sets share one, so no link between components is lost. Similarities are confirmed on the full sets.

Shingles are compared as 64-bit hashes. Defined cases: NULL and wordless texts have empty sets, link with nothing and are
kept; texts with fewer words than a shingle are one shingle; repeated rows link like any equal texts; with
repeated ids all rows of the smallest id are kept, and a component's id is NULL only if all its ids are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import discard, free_names, give_back, keep, keep_alone, row_key

SHINGLE, SIMILARITY = 5, 80  # words, percent
BANDS, ROWS = 32, 6
SPACE = 1 << 20
SEED = 20_240_101
REMEMBERED = 100_000
FEW = 8  # pairs per node, counted in every bucket, that may be left when the rounds end
MEET = 4  # other nodes that a node meets in a round
ROUNDS = 4
CROWD = 16  # nodes of a bucket that may all be compared with each other when the rounds end
PIECES = 16  # in which a shingle is counted
PAIR = ("a", "b", "label_a", "label_b")
SIGNED = "row_id long, row_hash long, doc_id long, n long, set_a long, set_b long, bands array<long>"


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _forgetting(work):
    """``work`` on the batches of a task, after which the worker holds no hashes of words: it waits beside later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _hashes.clear()
            give_back()

    return run


_MIX = np.uint64(0xFF51AFD7ED558CCD)  # fixed value: a mixing constant
_STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multiplier


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; words are cut at ASCII white space, only A-Z are lower-cased."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * _STEP + hashed[k : len(hashed) - width + k + 1])
    return np.unique(out)


class Circulant:
    """Both permutations; the second is laid out twice so that a shift is a slice."""

    def __init__(self, size: int):
        rng = np.random.default_rng(SEED)
        self.scatter = rng.permutation(SPACE).astype(np.uint32)
        ring = rng.permutation(SPACE).astype(np.uint32)
        self._shifts = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[: size - 1]]), size)
        self.size = size

    def signature(self, found: np.ndarray) -> np.ndarray:
        places = self.scatter[(found & np.uint64(SPACE - 1)).astype(np.int64)]
        least = np.full(self.size, SPACE, np.uint32)
        for k in range(0, len(places), 1024):
            np.minimum(least, self._shifts[places[k : k + 1024]].min(axis=0), out=least)
        return least


_circulant: list[Circulant] = []


def bands(found: np.ndarray) -> np.ndarray:
    """Bucket keys of a set, one per band."""
    if not _circulant:
        _circulant.append(Circulant(BANDS * ROWS))
    rows = _circulant[0].signature(found).reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * _STEP + rows[:, k])
    return keys


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per document: keys, set size, 128-bit identity of the set, bands (NULL for empty sets)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, identities, keys = [], [], []
            for text in batch.column(3):
                found = shingles(text.as_py(), size)
                counts.append(len(found))
                identities.append(xxhash.xxh3_128_digest(found.tobytes()))
                keys.append(bands(found).view(np.int64) if len(found) else None)
            parts = np.frombuffer(b"".join(identities), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(parts[:, 0]), pa.array(parts[:, 1]),
                 pa.array(keys, pa.list_(pa.int64()))],
                [field.split()[0] for field in SIGNED.split(", ")],
            )

    return docs.select(*row_key(), F.col("doc_id").cast("long"), "text").mapInArrow(_forgetting(sign), SIGNED)


def node_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Full sets of the nodes in ``wanted`` (node, row_id, row_hash)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text.as_py(), size).view(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "found"])

    rows = docs.select(*row_key(), "text").join(wanted, ["row_id", "row_hash"]).select("node", "text")
    return rows.mapInArrow(_forgetting(cut), "node long, found array<long>")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: longs): node, label, the least node of its component.

    Every round points each node at its least neighbour, halves the paths, and contracts the edges, until none is
    left. Each round's tables are written to the shared folder; hot nodes meet in aggregates and splittable joins.
    """
    edges = keep(edges.filter("a <> b").distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        up = least.select("a", F.least("a", "b").alias("up"))
        again = up.select(F.col("a").alias("up"), F.col("up").alias("top"))
        up = keep(up.join(again, "up").select("a", F.col("top").alias("up")), "up")
        moved = labels.join(up.select(F.col("a").alias("label"), "up"), "label", "left")
        labels = keep(moved.select("node", F.coalesce("up", "label").alias("label")), "labels")
        ends = edges.join(up, "a").select(F.col("up").alias("a"), "b")
        ends = ends.join(up.select(F.col("a").alias("b"), "up"), "b").select("a", F.col("up").alias("b"))
        fewer = keep(ends.filter("a <> b").distinct(), "edges")
        discard(edges)
        edges = fewer
        if edges.isEmpty():
            return labels


def linked(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, and the labels of both) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("found").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("found").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    enough = 100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)
    return pairs.join(left, "a").join(right, "b").filter(enough).select(*PAIR)


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def relabelled(labels: DataFrame, new: DataFrame) -> DataFrame:
    """``labels`` (node, label) after the links ``new`` have joined components. Only labels are contracted again."""

    def moved() -> DataFrame:
        links = keep(new, "links")
        tops = components(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
        tops = tops.select(F.col("node").alias("label"), F.col("label").alias("top"))
        return labels.join(tops, "label", "left").select("node", F.coalesce("top", "label").alias("label"))

    return keep_alone(moved, "labels")


def rarest(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """token, node, n, label, place: the shingles of each node of which two linked nodes share one.

    With all shingles in one order, here by the number of nodes that have them, the first one that two linked sets share
    is among the first n - ceil(n * percent / 100) + 1 of either. Shingles of one node take places but are not returned.
    A shingle is counted and looked up in pieces, so one that all nodes have is no hot key.
    """
    tokens = sets.join(nodes, "node").select(
        "node", "n", "label", F.pmod(F.xxhash64("node"), F.lit(PIECES)).alias("piece"), F.explode("found").alias("token")
    )
    pieces = keep(tokens.groupBy("token", "piece").agg(F.count("*").alias("c")), "counts")
    often = pieces.groupBy("token").agg(F.sum("c").alias("often")).filter("often > 1")
    looked_up = pieces.join(often, "token").select("token", "piece", "often")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    ordered = (
        tokens.join(looked_up, ["token", "piece"])
        .groupBy("node", "n", "label").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("shared"))
        .withColumn("alone", F.col("n") - F.size("shared")).filter(first > F.col("alone"))
        .withColumn("shared", F.slice("shared", F.lit(1), (first - F.col("alone")).cast("int")))
    )
    rows = ordered.select("node", "n", "label", "alone", F.posexplode("shared").alias("at", "entry"))
    return rows.select("entry.token", "node", "n", "label", (F.col("alone") + F.col("at")).alias("place"))


def rare_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a shingle of ``rarest`` and have room for a link after its place.

    The largest component at a shingle is met by the others but not by itself, however many nodes it has.
    """
    sizes = rows.groupBy("token", "label").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("token").agg(F.max_by("label", F.struct("c", "label")).alias("largest"), F.count("*").alias("labels"))
    rows = keep(rows.join(mixed.filter("labels > 1").drop("labels"), "token"), "rare")
    left = rows.filter("label <> largest").select(
        "token", "largest", *[F.col(c).alias(f"{c}_x") for c in ("node", "n", "label", "place")]
    )
    right = rows.select("token", *[F.col(c).alias(f"{c}_y") for c in ("node", "n", "label", "place")])
    room = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    met = left.join(right, "token").filter(
        (F.col("label_x") != F.col("label_y")) & ((F.col("label_y") == F.col("largest")) | (F.col("node_x") < F.col("node_y")))
        & _similar_sizes("n_x", "n_y", percent) & ((100 + percent) * room >= percent * (F.col("n_x") + F.col("n_y")))
    )
    return _ordered(met)


def _ordered(met: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) with labels, from node_x, label_x, node_y, label_y."""
    swap = F.col("node_x") > F.col("node_y")
    pick = lambda c, x, y: F.when(swap, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}"))
    return met.select(
        pick("node", "y", "x").alias("a"), pick("node", "x", "y").alias("b"),
        pick("label", "y", "x").alias("label_a"), pick("label", "x", "y").alias("label_b"),
    ).distinct()


def joined_labels(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """node, label: the components of all nodes linked over shared buckets. ``members``: bucket, node, n."""
    spark = members.sparkSession
    labels = keep(members.select("node").distinct().withColumn("label", F.col("node")), "labels")
    nodes = labels.count()
    done = spark.createDataFrame([], "a long, b long")
    turn = 0
    while True:
        labelled = keep(members.join(labels, "node"), "labelled")
        # The member that the others of a bucket meet: another one every round.
        order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node", "label", "n")
        parts = labelled.groupBy("bucket", "label").agg(F.min(order).alias("hub"), F.count("*").alias("c"))
        mixed = keep(
            parts.groupBy("bucket").agg(
                F.min("hub").alias("hub"), F.count("*").alias("labels"), F.sum("c").alias("c"),
                ((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2).alias("pairs"),
            ).filter("labels > 1"),
            "mixed",
        )
        # Pairs of different components in one bucket; those of several buckets count several times.
        left = mixed.agg(F.sum("pairs")).first()[0] or 0
        if left == 0:
            return labels
        if turn == ROUNDS or (turn and left <= FEW * nodes):
            break
        met = (
            labelled.join(mixed.select("bucket", "hub"), "bucket").filter(F.col("label") != F.col("hub.label"))
            .filter(100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n"))
            .select("node", "label", F.col("hub.node").alias("hub"), F.col("hub.label").alias("top")).distinct()
            .groupBy("node", "label")
            .agg(F.slice(F.sort_array(F.collect_list(F.struct(F.xxhash64("node", "hub"), "hub", "top"))), 1, MEET).alias("hubs"))
            .select(F.col("node").alias("node_x"), F.col("label").alias("label_x"), F.explode("hubs").alias("hub"))
            .select("node_x", "label_x", F.col("hub.hub").alias("node_y"), F.col("hub.top").alias("label_y"))
        )
        pairs = keep(_ordered(met).join(done, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            break
        done = done.unionByName(pairs.select("a", "b"))
        before, labels = labels, relabelled(labels, linked(sets, pairs, percent))
        for table in (before, labelled, mixed):
            discard(table)
        turn += 1
    # What is left: all pairs of small buckets; of the nodes of crowded ones those that share one of their rarest shingles.
    rest = keep(labelled.join(mixed.select("bucket", (F.col("c") > CROWD).alias("crowded")), "bucket"), "rest")
    small = rest.filter(~F.col("crowded"))
    left, right = (small.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "label")]) for side in "xy")
    met = left.join(right, "bucket").filter(
        (F.col("node_x") < F.col("node_y")) & (F.col("label_x") != F.col("label_y")) & _similar_sizes("n_x", "n_y", percent)
    )
    crowd = rest.filter("crowded").select("node", "n", "label").distinct()
    crowded = rare_pairs(keep(rarest(sets, crowd, percent), "rarest"), percent)
    pairs = keep(_ordered(met).unionByName(crowded).distinct().join(done, ["a", "b"], "left_anti"), "pairs")
    return relabelled(labels, linked(sets, pairs, percent))


def grouped(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """Per document: row_id, row_hash, doc_id, n_shingles, label, component_id, kept.

    ``label`` tells components apart, also those whose ids are equal or all NULL; it is NULL for empty sets.
    """
    signed = keep(signatures(docs, size), "signatures")
    named = keep_alone(lambda: named_sets(docs, signed, size, percent), "named")
    first = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = named.join(first, "label").select("set_a", "set_b", "label", "component_id")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return (
        signed.drop("bands").join(of_set, ["set_a", "set_b"], "left")
        .select("row_id", "row_hash", "doc_id", F.col("n").alias("n_shingles"), "label", own)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def named_sets(docs: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    """set_a, set_b, least (its smallest id), label: every distinct set and its component."""
    nodes = keep(
        signed.filter("n > 0").groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"),
             F.min(F.struct("row_id", "row_hash")).alias("row"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    dealt = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1").select("bucket")
    members = keep(dealt.join(shared, "bucket"), "members")
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", "row.*")
    sets = keep(node_sets(docs, wanted, size).dropDuplicates(["node"]), "sets")
    labels = joined_labels(sets, members, percent)
    return nodes.join(labels, "node", "left").select("set_a", "set_b", "least", F.coalesce("label", "node").alias("label"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """Per document: row_id, row_hash, doc_id, n_shingles, component_id, kept."""
    return grouped(docs, size, percent).drop("label")


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """One document of each group stays, with all its columns; empty sets stay.

    ``docs`` must be a stored table. Of repeated rows with a group's smallest id, the first by place stays.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    row_id, row_hash, at = free_names(docs, "row_id", "row_hash", "place")
    keyed = docs.withColumns({row_id: row_key()[0], row_hash: row_key()[1], at: place})

    def places() -> DataFrame:
        found = grouped(docs, size, percent).filter("kept").select("row_id", "row_hash", "label", "n_shingles").distinct()
        candidates = keyed.select(
            F.col(row_id).alias("row_id"), F.col(row_hash).alias("row_hash"), F.col(at).alias("place")
        ).join(found, ["row_id", "row_hash"])
        one = candidates.filter("n_shingles > 0").groupBy("label").agg(F.min("place").alias(at)).select(at)
        return one.unionByName(candidates.filter("n_shingles = 0").select(F.col("place").alias(at)))

    chosen = keep_alone(places, "chosen")
    return keyed.join(chosen, at, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
