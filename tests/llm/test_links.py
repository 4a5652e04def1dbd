"""SimHash groups, alignment of tokenizers, hard negatives and components against plain versions."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from parcelworks.llm import align, groups, hard_negatives, queries, scan, simhash, word_table

FOLDER = "/root/testdata/sf0.001"
BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = st.lists(st.sampled_from(list("aB.,'é|1 \n\t\r\x0b  İß$☃́▁") + ["'s", " a", "<|endoftext|>", "<0x41>", " wo"]), max_size=40)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


# ---- components -----------------------------------------------------------------------------


def test_components_take_few_rounds(spark, monkeypatch):
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(1000)]
    star = [(5000, 5001 + i) for i in range(300)]
    clique = [(i, j) for i in range(7000, 7030) for j in range(7000, i)]
    late_star = [(9000 + i, 9500) for i in range(300)]
    edges = chain + star + clique + late_star + [(8000, 8000), (8001, 8001), (8001, 8002), (None, 4)]
    r.shuffle(edges)
    names = []
    monkeypatch.setattr(groups, "stored", lambda df, name, real=groups.stored: (names.append(name), real(df, name))[1])
    found = {row.id: row.component for row in groups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [edge for edge in edges if edge[0] is not None]
    assert found == brute.components_of({key for edge in linked for key in edge}, linked)
    assert names.count("moves") <= 12


def test_components_of_nothing(spark):
    assert groups.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- 11 SimHash -----------------------------------------------------------------------------


def test_simhash_groups(docs, rows, nothing):
    found = {row.doc_id: tuple(row)[1:] for row in simhash.near_duplicate_groups(docs).collect()}
    assert found == brute.simhash_groups(rows)
    assert len({component for _, component in found.values()}) < len(found)
    assert simhash.near_duplicate_groups(nothing).collect() == []


def test_simhash_of_odd_tables(keyless):
    found = rows_of(simhash.near_duplicate_groups(keyless))
    assert len(found) == 8
    assert [row[2] for row in found if row[0] is None] == [None] * 6
    assert {row[0]: row[2] for row in found if row[0]} == {1: 1, 2: 2}
    assert {row[1] for row in found if row[0] == 2} == {"0" * 16}


def test_simhash_query(spark):
    found = {row.doc_id: tuple(row)[1:] for row in queries.op11_simhash(spark, FOLDER).collect()}
    assert found == brute.simhash_groups(documents(spark))


def clustered(r, n):
    """Fingerprints around few centres, some far beyond the distance, in correlated bits."""
    centres = [r.getrandbits(64) for _ in range(5)] + [0, 2**64 - 1]
    found = set()
    while len(found) < n:
        value = r.choice(centres)
        for _ in range(r.randint(0, 7)):
            value ^= 1 << r.randrange(64)
        found.add(value)
    return found


@pytest.mark.parametrize("parts", simhash.PARTITIONS)
@pytest.mark.parametrize("block", [simhash.BLOCK, 40])
def test_no_link_is_lost(spark, parts, block, monkeypatch):
    """Each number of partitions, and buckets cut into blocks, gives all links of dense and thin places."""
    monkeypatch.setattr(simhash, "PARTITIONS", (parts,))
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(parts)
    prints = sorted(clustered(r, 700) | {r.getrandbits(64) for _ in range(150)})
    texts = {value: f"t{i}" for i, value in enumerate(prints)}
    monkeypatch.setattr(
        simhash, "_fingerprint_rows",
        lambda batches: (
            scan.batch_of(pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())]), doc_id=batch.column("doc_id"),
                          fingerprint=[simhash._signed(prints[int(t[1:])]) for t in batch.column("text").to_pylist()])
            for batch in batches),
    )
    table = spark.createDataFrame([(i, texts[value]) for i, value in enumerate(prints)], "doc_id long, text string")
    found = {row.doc_id: row.component_id for row in simhash.near_duplicate_groups(table).collect()}
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert found == brute.components_of(range(len(prints)), links)


def test_thresholds_add_up_and_are_the_cheapest():
    r = random.Random(1)
    prints = np.array(sorted(clustered(r, 400)), dtype=np.uint64)
    bits = simhash.bits_of(prints).astype(np.int64)
    parts = simhash.Partitioning(simhash.grouped_bits(bits.T @ bits, len(prints), 3))
    parts.learn(parts.half_counts(prints), len(prints))
    assert sorted(parts.order.tolist()) == list(range(64)) and sorted(parts.widths) == [21, 21, 22]
    found = parts.thresholds(parts.reordered(prints))
    assert (found.sum(axis=0) == 3 - 3 + 1).all() and found.min() >= -1
    assert len({tuple(column) for column in found.T.tolist()}) > 1


def test_correlated_bits_share_a_partition():
    r = np.random.default_rng(5)
    free = r.integers(0, 2, (3000, 32))
    bits = np.concatenate([free, free ^ (r.random((3000, 32)) < 0.05)], axis=1)
    parts = simhash.grouped_bits(bits.T @ bits, len(bits), 4)
    together = {frozenset((bit % 32 for bit in part)) for part in parts}
    assert all(len(some) == 8 for some in together)


# ---- 12 alignment ---------------------------------------------------------------------------


@given(st.lists(ODD.map("".join), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_words_align_as_whole_texts(texts):
    known = align.tokenizers_of(BYTE, PIECE)
    sizes, digests, keys, places = align._sliced(known, pa.array([*texts, None], pa.string()))
    expected = brute.alignment(list(enumerate([*texts, None])), BYTE, PIECE)
    assert [(*s, d) for s, d in zip(sizes.tolist(), digests)] == [(*row[1:5], row[7]) for row in expected]
    assert np.bincount(places, minlength=len(texts) + 1).tolist() == sizes[:, 3].tolist() and len(keys) == len(places)


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 99), st.integers(1, 9)), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_bitmaps_come_back(postings):
    times = {(pair, place): n for pair, place, n in postings}
    pairs = sorted({pair for pair, _ in times})
    order = sorted(times)
    columns = [np.array(values) for values in ([pairs.index(p) for p, _ in order], [d for _, d in order], [times[o] for o in order])]
    found = align.Bitmaps(align.pack_bitmaps(np.array(pairs) * 10**9, *columns, 100))
    assert found.pairs.tolist() == [pair * 10**9 for pair in pairs]
    assert found.documents().tolist() == [sum(p == pair for p, _ in times) for pair in pairs]
    assert found.links().tolist() == [sum(n for (p, _), n in times.items() if p == pair) for pair in pairs]
    back = {}
    for pair, place, weight in found.postings():
        for p, d in zip(pair.tolist(), place.tolist()):
            back[pairs[p], d] = back.get((pairs[p], d), 0) + weight
    assert back == times


@pytest.mark.parametrize(("links", "pairs"), [(align.BLOCK_LINKS, align.TASK_PAIRS), (500, 300)])
def test_alignment(docs, rows, links, pairs, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_LINKS", links)
    monkeypatch.setattr(align, "TASK_PAIRS", pairs)
    found = rows_of(align.align_documents(docs, BYTE, PIECE))
    assert found == sorted(brute.alignment(rows, BYTE, PIECE), key=repr)


def test_alignment_of_odd_tables(keyless, nothing):
    found = rows_of(align.align_documents(keyless, BYTE, PIECE))
    given = [(row.doc_id, row.text) for row in keyless.collect()]
    assert found == sorted(brute.alignment(given, BYTE, PIECE), key=repr)
    assert align.align_documents(nothing, BYTE, PIECE).collect() == []


def test_pairs_of_the_corpus(docs, rows):
    table = align.encoded(docs, BYTE, PIECE)
    pairs = align.pair_table(align.pair_counts(table)).collect()
    documents = brute.alignment(rows, BYTE, PIECE)
    assert sum(row.links for row in pairs) == sum(row[4] for row in documents)
    assert sum(row.links for row in pairs) > sum(row.documents for row in pairs) > 0
    assert len({(row.a, row.b) for row in pairs}) == len(pairs)


def test_alignment_query(spark):
    found = rows_of(queries.op12_alignment(spark, FOLDER))
    assert found == sorted(brute.alignment(documents(spark), BYTE, PIECE), key=repr)


def test_forgotten_words_are_encoded_again(rows):
    texts = pa.array([text for _, text in rows], pa.string())
    data = scan.text_bytes(texts)
    words = scan.Words(*data)
    calls = []

    def encode(some, kind):
        calls.append(len(some))
        lengths = np.array(list(map(len, some)))
        yield np.arange(len(some)), [(np.frombuffer(b"".join(some), dtype=np.uint8), lengths)]

    table = word_table.WordTable(encode, [np.uint8], limit=50)
    raw = data[0].tobytes()
    for _ in range(3):
        flat, _ = table.columns[0].take(table.entries(words))
        assert flat.tobytes() == b"".join(raw[a:b] for a, b in zip(words.starts, words.ends))
    assert len(calls) == 3 and calls[1] < calls[0]


# ---- 13 hard negatives ----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score double, block int, ids string, vector string"


def vectors(spark, rows):
    return spark.createDataFrame([(*row, None, 1, "x", "y") for row in rows], VECTORS).repartition(3)


def mined(table):
    return rows_of(hard_negatives.mine(table, "vec_id % 100 = 0"))


@pytest.mark.parametrize("anchors", [hard_negatives.BLOCK_ANCHORS, 3])
def test_hard_negatives(spark, anchors, monkeypatch):
    """Clusters, so that bounds leave rows out; ties, repeats, odd rows; few and many blocks."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "BLOCK_CANDIDATES", 64)
    r = random.Random(2)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [
        (10 * i, [x + r.choice([0, 0.01, 0.3, 1]) * r.gauss(0, 1) for x in r.choice(centres)], r.randint(0, 3))
        for i in range(300)
    ]
    rows += [(7, rows[5][1], 1), (3001, rows[5][1], 2), (3002, rows[5][1], 1)]
    rows += [(None, rows[1][1], 1), (3100, None, 1), (3200, [1.0, None], 1), (3300, [float("nan")] * 8, 1)]
    rows += [(3400, [float("inf")] * 8, 1), (3500, rows[2][1], None), (3600, [], 2), (3700, [2.0, 1.0], 0), (3800, [0.0] * 8, 1)]
    rows += [(3900, [3e20] * 8, 2), (3901, [1e20] * 8, 1), (3902, [2.9e20] * 8, 2)]
    rows += [(4000, [3e6] * 8, 0), (4001, [1e6] * 8, 1), (4002, [2.9e6] * 8, 0)]
    narrow = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for k, v, label in rows]
    expected = brute.hard_negatives(narrow)
    assert mined(vectors(spark, rows)) == sorted(expected, key=repr)
    assert len(expected) > 500


def test_hard_negatives_of_odd_tables(spark):
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(1, [1.0], 1)])) == []
    twice = [(100, [1.0, 1.0], 1), (100, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, [0.5, 0.5], 2), (3, [0.5, 0.5], 2)]
    found = mined(vectors(spark, twice))
    assert found == 2 * [] + sorted(2 * [(100, 2, rank, 3, 131072, 65536) for rank in (1, 2)])


def test_bounds_leave_rows_out():
    r = np.random.default_rng(4)
    centres = r.normal(size=(4, 16)) * 200
    anchors = np.floor(np.concatenate([c + r.normal(size=(8, 16)) for c in centres]))
    row = {"block": 0, "ids": np.arange(32).astype("<i8").tobytes(), "labels": np.zeros(32, "<i8").tobytes(),
           "vectors": anchors.astype("<f8").tobytes(), "width": 16}
    block = hard_negatives.Block(row)
    candidates = np.floor(r.normal(size=(500, 16)) * 200)
    exact = anchors @ candidates.T
    top = np.sort(exact, axis=1)[:, -10]
    seen = np.zeros(exact.shape, dtype=bool)
    for places, scores, which in block.scores(candidates, lambda some, low, high: high >= top[some, None]):
        assert (scores[which] == exact[places][which]).all()
        seen[places] |= which
    assert seen[exact >= top[:, None]].all() and block.scored < 0.5 * block.seen


def test_hard_negative_query(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label) for r in table.collect()]
    found = queries.op13_hard_negatives(spark, FOLDER)
    assert rows_of(found) == sorted(brute.hard_negatives(rows), key=repr)


def test_hard_negative_sql(spark):
    from compare import database, differences

    found = queries.op13_hard_negatives(spark, FOLDER)
    assert differences(found, database(FOLDER), queries.ORACLE["op13_hard_negatives"]) == []
