"""Plane files and packing against plain computations over all documents."""

import json
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelyard.llm import encoding, packing, queries, token_planes
from parcelyard.llm.common import table

VOCABULARY = encoding.default_vocabulary()
PLAIN = Tokenizer.from_file(VOCABULARY)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab 's\n\t \x1c\x85éß12,.<|endoftext|>", max_size=40))
def test_remembered_pieces_give_the_ids_of_the_whole_text(text):
    want = struct.pack(f"<{len(ids_of(text))}I", *ids_of(text))
    assert encoding.encoder(VOCABULARY).packed(text) == want


def test_text_of_a_special_token():
    text = "a <|endoftext|> b"
    assert encoding.encoder(VOCABULARY).packed(text) == struct.pack(f"<{len(ids_of(text))}I", *ids_of(text))


@pytest.mark.parametrize("kind", ["byte", "bit"])
@settings(max_examples=50, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_planes_round_trip(kind, ids):
    packed = struct.pack(f"<{len(ids)}I", *ids)
    assert token_planes.from_planes(token_planes.to_planes(packed, kind), len(ids), kind) == packed


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_round_trip_and_ranges(tmp_path, monkeypatch, kind):
    monkeypatch.setattr(token_planes, "CHUNK_IDS", 7)
    writer = token_planes.PlaneWriter(f"file://{tmp_path}/a.ids", kind)
    documents = [(None, [5]), (1, list(range(20))), (1, []), (2**40, [70000, 2**32 - 1, 0] * 5)]
    for doc_id, ids in documents:
        writer.add(doc_id, struct.pack(f"<{len(ids)}I", *ids))
    writer.close()
    reader = token_planes.PlaneReader(f"file://{tmp_path}/a.ids")
    whole = [i for _, ids in documents for i in ids]
    for start in range(len(whole)):
        for stop in range(start, len(whole) + 1):
            assert reader.ids(start, stop).tolist() == whole[start:stop]
    assert list(reader.crcs()) == [crc(ids) for _, ids in documents]


def brute_tokens(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = ids_of(text)
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_op4_matches_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = [tuple(r) for r in queries.op4_token_planes(spark, sf).orderBy("doc_id").collect()]
    assert got == brute_tokens(rows)


def test_op4_hard_rows(spark, hard):
    got = token_planes.token_files(hard, kind="bit").collect()
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (d, len(ids_of(t)), crc(ids_of(t))) for d, t in rows
    )
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 4, 4, 5]
    assert token_planes.token_files(hard.limit(0)).collect() == []


def check_packing(rows, texts, capacity):
    """Everything a packing must hold; returns the number of sequences."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for doc_id, text in texts:
        ids = ids_of(text)
        for k, (start, n) in enumerate(packing.cut(len(ids), capacity)):
            want[(doc_id, k, start, n, crc(ids[start : start + n]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    return len(sequences)


def test_op7_matches_the_texts_and_packs_well(spark, sf):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    rows = queries.op7_best_fit_packing(spark, sf).collect()
    used = check_packing(rows, texts, 1024)
    total = sum(r["length"] for r in rows)
    assert used <= 1.02 * -(-total // 1024) + 1


def test_op7_hard_rows(spark, hard):
    texts = [(r["doc_id"], r["text"]) for r in hard.collect()]
    assert check_packing(packing.pack_documents(hard, 16).collect(), texts, 16)
    assert packing.pack_documents(hard.limit(0)).collect() == []


def best_fit_decreasing(counts, capacity):
    """Sequences that the one-by-one algorithm needs."""
    rooms = []
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(counts=st.dictionaries(st.integers(1, 32), st.integers(0, 60), max_size=20))
def test_rounds_place_every_piece_once(counts):
    capacity, room, seen = 32, defaultdict(int), Counter()
    spans = defaultdict(list)
    for length, first, last, sequence, fit, used in packing.match_rounds(counts, capacity):
        for rank in range(first, last + 1):
            at = (rank - first) // fit + sequence
            seen[(length, rank)] += 1
            room[at] += length
            spans[at].append((used + (rank - first) % fit * length, length))
    assert seen == Counter((k, r) for k, n in counts.items() for r in range(n))
    assert all(v <= capacity for v in room.values())
    for places in spans.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]]
    assert len(room) <= 1.05 * best_fit_decreasing(counts, capacity) + 1


def test_words_and_white_space_are_cut_as_the_library_does():
    rng, letters = random.Random(3), " \n\t\rab'sté1,.<|>-é“ABst日 \u0085x"
    made = encoding.Encoder(VOCABULARY)
    for _ in range(8000):
        text = "".join(rng.choices(letters, weights=[6, 2, 1, 1] + [1] * (len(letters) - 4), k=rng.randrange(14)))
        assert made.packed(text) == struct.pack(f"<{len(ids_of(text))}I", *ids_of(text)), text
    few = encoding.Encoder(VOCABULARY)
    few._words.most = few._pieces.most = 5  # generations pass
    for _ in range(300):
        text = " ".join("".join(rng.choices("abcdé,", k=rng.randrange(4))) for _ in range(12))
        assert few.packed(text) == made.packed(text)
    assert len(few._words) <= 6 >= len(few._words.older)


def test_a_vocabulary_that_cuts_otherwise_is_left_to_the_library(tmp_path):
    said = json.loads(open(VOCABULARY).read())
    assert encoding.Encoder(VOCABULARY)._by_pieces
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"pre_tokenizer": {**said["pre_tokenizer"], "add_prefix_space": True}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**said, **change}))
        other = encoding.Encoder(str(path))
        ids = other._tokenizer.encode("Two Words, here", add_special_tokens=False).ids
        assert not other._by_pieces and other.packed("Two Words, here", None) == struct.pack(f"<{len(ids)}I", *ids)


def test_words_remembered_are_bounded_and_change_no_ids():
    few, many = (encoding.Encoder(encoding.default_vocabulary(), words) for words in (40, 10_000))
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(n, n + 50)) for n in range(0, 600, 30)]
    assert [few.packed(t) for t in texts] == [many.packed(t) for t in texts]
    assert len(few._words) <= 40 and len(few._words.older) <= 40 < len(many._words)


def test_packing_hands_few_documents_at_once_to_python(spark, tmp_path, monkeypatch):
    """A stage of the pipeline held 10,000 documents in the JVM and its worker, beside a million words."""
    seen, real = [], packing.keep
    monkeypatch.setattr(packing, "keep", lambda df, label: seen.append(
        max(r[0] for r in spark.range(5_000).coalesce(1).mapInArrow(sizes, "n long").collect())) or real(df, label))

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(5_000).coalesce(1).selectExpr("id as doc_id", "concat('text ', id) as text")
    assert packing.pack_documents(docs, words=100).count() == 5_000
    assert seen == [packing.BATCH] and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
