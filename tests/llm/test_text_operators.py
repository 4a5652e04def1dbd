"""The ten operators against plain versions, exact round trips and held-out labels."""

import random
from functools import cache

import brute
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import assume, given, settings, strategies as st

from parcelworks.llm import (
    ans,
    archive,
    decontaminate,
    fingerprint,
    lines,
    near_copies,
    packing,
    pii,
    quality,
    queries,
    scan,
    substrings,
    token_files,
    tokens,
)
from parcelworks.llm.ordering import new_folder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = st.lists(st.sampled_from(list("aB.,'é|1 \n\t\r\x0b  İß$☃́") + ["'s", " a", "<|endoftext|>"]), max_size=40).map("".join)


def by_key(df, *columns):
    return {row[0]: tuple(row[1:]) for row in df.select(*columns).collect()}


# ---- helpers --------------------------------------------------------------------------------


@given(st.lists(ODD, max_size=6))
@settings(max_examples=150, deadline=None)
def test_words_and_shingles(texts):
    data, offsets = scan.text_bytes(pa.array([*texts, None], pa.string()))
    words = scan.Words(data, offsets, lower=True)
    raw = data.tobytes()
    for number, text in enumerate(texts):
        a, b = words.bounds[number], words.bounds[number + 1]
        found = [raw[words.starts[i] : words.ends[i]].decode() for i in range(a, b)]
        assert found == brute.words_of(text)
        assert len(words.shingles(5)[number]) == len(brute.shingles_of(text))
    whole = scan.Words(*scan.text_bytes(pa.array(["".join(texts)], pa.string())), lower=True)
    alone = {w: h for w, h in zip(brute.words_of(brute.lowered("".join(texts))), whole.hash.tolist())}
    assert len(set(alone.values())) == len(alone)


@cache
def library(path):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


@given(ODD)
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_library(text):
    for path in (BYTE, WORD):
        expected = library(path).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens.encoder(path).encode(text.encode()), "<u4").tolist() == expected


def test_ids_with_a_small_memory():
    small = tokens.Encoder(BYTE, kept_words=3)
    text = "Some words, some more words. And words\nagain, some"
    assert np.frombuffer(small.encode(text.encode()), "<u4").tolist() == library(BYTE).encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 50_256), max_size=400), st.integers(1, 5))
@settings(max_examples=40, deadline=None)
def test_coded_ids_come_back(ids, documents):
    ids = np.array(ids * 3, dtype=np.uint32)
    data = ans.encode(np.arange(documents), np.array([len(ids)] + [0] * (documents - 1)), np.zeros(documents), ids) + b"\n"
    segment = next(ans.segments(data))
    assert segment.ids().tolist() == ids.tolist()
    assert len(list(ans.segments(data + data))) == 2


def test_blocks_decode_alone_and_faults_are_seen():
    ids = np.random.default_rng(1).integers(0, 3000, 200_000).astype(np.uint32)
    data = ans.encode(np.array([1]), np.array([len(ids)]), np.zeros(1), ids)
    segment = ans.Segment(memoryview(data), 0)
    size = segment.steps * segment.lanes
    assert segment.blocks > 2 and segment.ids(1, 2).tolist() == ids[size : 2 * size].tolist()
    assert len(data) < 200_000 * 1.6
    broken = bytearray(data)
    broken[-9] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        ans.Segment(memoryview(bytes(broken)), 0).ids()


# ---- 1 fingerprints -------------------------------------------------------------------------


def test_fingerprints(docs, rows, nothing, keyless):
    found = fingerprint.fingerprint_documents(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in found} == brute.edited_digests(rows)
    texts = dict(rows)
    prints = {}
    for row in found:
        assert prints.setdefault(texts[row.doc_id] or "", row.fingerprint) == row.fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    ordered = sorted(rows, reverse=True)
    exact = {}
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        a = brute.shingles_of(text)
        b = brute.shingles_of(fingerprint.edited(text or "", following or ""))
        exact[key] = len(a & b) / len(a | b) if a | b else 1.0
    gaps = [abs(exact[row.doc_id] - row.near_edited) for row in found]
    assert max(gaps) < 0.15 and np.mean(gaps) < 0.03
    assert fingerprint.fingerprint_documents(nothing).count() == 0
    assert fingerprint.fingerprint_documents(keyless).count() == 8
    assert fingerprint.fingerprint_documents(keyless.filter("doc_id IS NULL")).count() == 6
    assert fingerprint.fingerprint_documents(docs.filter("doc_id = 0")).count() == 1


def test_likeness_of_fingerprints_is_unbiased():
    random_ = np.random.default_rng(2)
    for share in (0.1, 0.5, 0.9):
        found = []
        for _ in range(60):
            pool = random_.integers(0, 2**64, 300, dtype=np.uint64)
            common = int(300 * share)
            one, two = np.unique(pool), np.unique(np.concatenate([pool[:common], random_.integers(0, 2**64, 300 - common, dtype=np.uint64)]))
            found.append(fingerprint.likeness(*fingerprint.sketches([one, two])))
        assert np.mean(found) == pytest.approx(common / (600 - common), abs=0.02)


# ---- 2 decontamination ----------------------------------------------------------------------


def _distance(pattern, text):
    best, before = len(pattern), list(range(len(pattern) + 1))
    for letter in text:
        now = [0]
        for i in range(1, len(pattern) + 1):
            now.append(min(before[i] + 1, now[i - 1] + 1, before[i - 1] + (pattern[i - 1] != letter)))
        before = now
        best = min(best, now[-1])
    return best


@given(st.text("ab c", min_size=1, max_size=90), st.text("ab c", max_size=60))
@settings(max_examples=200, deadline=None)
def test_bit_parallel_distance(pattern, text):
    assert decontaminate.nearest(pattern, text)[0] == _distance(pattern, text)


def test_decontamination(spark, nothing, keyless):
    r = random.Random(3)
    item = " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(40))
    other = " ".join("".join(r.choice("klmnopqr") for _ in range(6)) for _ in range(20))
    near, far = list(item), list(item)
    for place in range(0, len(item), 16):
        near[place] = "z"
    for place in range(0, len(item), 5):
        far[place] = "z"
    texts = {
        1: f"before {item.upper()} after", 2: "x " + "".join(near) + " y", 3: "x " + "".join(far),
        4: None, 5: "", 6: other.replace(" ", "\n  "), 7: item[:120], 8: f"{item} {other}", 9: f"{item} {other}",
    }
    docs = spark.createDataFrame([(k, t, "kept") for k, t in texts.items()], "doc_id long, text string, distance string")
    benchmark = spark.createDataFrame(
        [(10, item), (11, other), (12, None), (13, " "), (None, item)], "item_id long, text string"
    )
    found = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_items(docs, benchmark).collect()}
    errors = decontaminate.budget_of(decontaminate.normalised(item))
    brute_found = {
        (k, n): _distance(decontaminate.normalised(i), decontaminate.normalised(t or ""))
        for k, t in texts.items() for n, i in ((10, item), (11, other))
    }
    budgets = {10: errors, 11: decontaminate.budget_of(decontaminate.normalised(other))}
    within = {pair: d for pair, d in brute_found.items() if d <= budgets[pair[1]]}
    # the item without a key has the text of item 10
    assert found == within | {(k, None): d for (k, n), d in within.items() if n == 10}
    assert {k for k, _ in found} == {1, 2, 6, 8, 9} and found[2, 10] == 15
    clean = decontaminate.without_items(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 7]
    assert decontaminate.find_items(nothing, benchmark).count() == 0
    assert decontaminate.find_items(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.without_items(docs, benchmark.limit(0)).count() == 9
    assert decontaminate.find_items(keyless, benchmark).count() == 0


def test_items_without_a_key_are_kept_out(spark):
    passages = [" ".join(f"{letter}{n}" for n in range(30)) for letter in "abc"]
    docs = spark.createDataFrame(list(enumerate(f"x {p} y" for p in passages)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, passages[0]), (None, passages[1]), (None, None)], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.without_items(docs, benchmark).collect()] == [2]


@given(st.lists(st.text("ab c", min_size=1, max_size=40), min_size=1, max_size=4), st.text("ab c", max_size=120))
@settings(max_examples=200, deadline=None)
def test_matcher_gives_each_item_its_least_distance(items, text):
    items = [(n, decontaminate.normalised(i)) for n, i in enumerate(items) if decontaminate.normalised(i)]
    assume(items)
    text = decontaminate.normalised(text)
    found = {n: d for n, d, _ in decontaminate.Matcher(items, 0.2).matches(text)}
    nearest = {place: _distance(item, text) for place, (_, item) in enumerate(items)}
    assert found == {n: d for n, d in nearest.items() if d <= decontaminate.budget_of(items[n][1], 0.2)}


def test_a_piece_that_hits_everywhere_is_looked_into_once():
    """A megabyte in which one piece of an item stands again and again, and the item never."""
    item = "abcdefghijklm" + "".join(chr(97 + n * 7 % 26) for n in range(60))
    matcher = decontaminate.Matcher([(1, item)])
    piece = decontaminate.pieces_of(item, decontaminate.budget_of(item))[0][1]
    text = f"{piece} " * (1_000_000 // (len(piece) + 1))
    assert [end - begin >= len(text) - 200 for begin, end in matcher.regions(text)[0]] == [True]
    assert list(matcher.matches(text)) == []


def test_many_blocks_give_what_one_gives(spark):
    r = random.Random(5)
    items = [" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(12 + 5 * (n % 4))) for n in range(9)]
    texts = [f"x {items[n % 9]} y {items[n * 2 % 9]}" if n % 3 else f"clean {n}" for n in range(30)] + [None, ""]
    rows = [(n, t, f"c{n}", f"d{n}") for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, `Given_text x` string")
    benchmark = spark.createDataFrame([*enumerate(items), (3, items[0]), (None, items[1])], "item_id long, text string")
    sizes = [len(block) for block in decontaminate.blocks_of(benchmark, size=4)]
    assert sizes == [4, 4, 3]
    chars = [sum(len(i) for _, i in block) for block in decontaminate.blocks_of(benchmark, chars=200)]
    assert len(chars) > 3 and all(c <= 200 for c in chars)
    assert [len(b) for b in decontaminate.blocks_of(benchmark, chars=1)] == [1] * 11
    one = sorted(map(str, decontaminate.find_items(docs, benchmark).collect()))
    free = sorted(map(str, decontaminate.without_items(docs, benchmark).collect()))
    assert len(one) > 30 and len(free) == 12
    for limits in ({"size": 4}, {"chars": 200}):
        assert sorted(map(str, decontaminate.find_items(docs, benchmark, **limits).collect())) == one
        kept = decontaminate.without_items(docs, benchmark, **limits)
        assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == free


# ---- 3 personal data ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii.labelled_rows())


PERSONAL = st.lists(
    st.sampled_from(["a.b@c.de", "x@y", "@", "a@b.c_d@e.f", "1.2.3.4", "1.2.3.4.5", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (222) 555-0100", "+1", " ", "\n", "word", "12", ".", "-", "é"]),
    max_size=12,
).map("".join)


@pytest.mark.parametrize(
    "text",
    ["1" * 10**6 + " 1.2", "a" * 10**6 + "@b c@", "1." * 5 * 10**5, "@a" * 3 * 10**5, "a@b.c" * 2 * 10**5, "+1 " * 3 * 10**5,
     "x@y.zz 10.0.0.1 " * 6 * 10**4],
    ids=["digits", "letters", "dots", "signs", "mails", "pluses", "spans"],
)
def test_a_long_text_takes_seconds(field, text):
    import time

    start = time.process_time()
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([text])], ["doc_id", "text"])
    found = list(pii._span_rows(field)(iter([batch])))[0].to_pylist()[0]
    assert time.process_time() - start < 60
    assert found["n_spans"] >= found["n_email"] + found["n_ip"]
    if text.startswith("x@y"):
        assert found["n_email"] == found["n_ip"] == 6 * 10**4


@given(PERSONAL)
@settings(max_examples=300, deadline=None)
def test_base_spans(text):
    plain = []
    for kind, pattern in (("email", pii.EMAIL), ("ip", pii.IP), ("card", pii.CARD), ("phone", pii.PHONE)):
        plain += [(kind, *m.span()) for m in pattern.finditer(text) if pii.passes(kind, m[0])]
    assert pii.base_spans(text) == plain


def test_field_on_sentences_not_trained_on(field):
    wrong = total = 0
    for _, words, states in pii.labelled_rows(200, seed=99):
        found = field.decode(np.array([field.ids(words)]), np.array([len(words)]))[0]
        wrong += sum(pii.STATES[a] != b for a, b in zip(found, states))
        total += len(words)
    assert wrong / total < 0.01


def test_viterbi_is_the_best_path(field):
    from itertools import product

    ids = np.array([field.ids("token = \"0123456789abcdef0123456789abcdef01234567\" on".split())])
    scores = field.emissions(ids)[0]
    best = max(
        product(range(len(pii.STATES)), repeat=ids.shape[1]),
        key=lambda path: field.begin[path[0]] + sum(scores[i, s] for i, s in enumerate(path)) + sum(field.transition[a, b] for a, b in zip(path, path[1:])),
    )
    assert tuple(field.decode(ids, np.array([ids.shape[1]]))[0]) == best


def test_personal_data(spark, rows, docs, nothing, keyless):
    labelled = pii.labelled_table(spark)
    found = by_key(pii.find_personal_data(docs, labelled), "doc_id", "spans")
    assert len(found) == len(rows) and all(spans == ("",) for spans in found.values())
    secret = "0123456789abcdef" * 2 + "01234567"
    texts = {
        1: f'éé token = "{secret}" x', 2: "mail a.b@c.de now", 3: "call +1 (222) 555-0100 4111111111111111 now", 4: None,
        5: "only words, and a number 1234 or 12.5%",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows_ = {r.doc_id: r for r in pii.find_personal_data(df, labelled).collect()}
    assert rows_[1].spans == f"secret:12:{12 + 40}" and rows_[1].base == ""
    assert rows_[2].spans == rows_[2].base == "email:5:13" and rows_[2].n_email == 1
    assert rows_[3].base == "" and "phone:5:22" in rows_[3].spans
    assert rows_[4].spans == "" and rows_[5].spans == ""
    assert pii.find_personal_data(nothing, labelled).count() == 0
    assert pii.find_personal_data(keyless, labelled.limit(0)).count() == 8


def test_addresses_spelled_in_plain_words(spark):
    """Wherever they stand, as most of their texts hold no digit and no mark."""
    addresses = [
        words[n : n + 5] for _, words, states in pii.labelled_rows(300, seed=77)
        for n in range(len(words) - 4) if states[n] == "email" and words[n + 1] == "at"
    ]
    assert len(addresses) > 20
    addresses += [f"{name} at example dot com".split() for name in ("jane", "jane7", "jane.doe")]
    prose = "some plain words of prose that stand around it "
    texts, expected = {}, {}
    for number, address in enumerate(addresses):
        before, spelled = prose * (number % 3), " ".join(address)
        texts[number] = before + spelled + (" " + prose if number % 2 else "")
        expected[number] = (f"email:{len(before)}:{len(before) + len(spelled)}",)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert by_key(pii.find_personal_data(df, pii.labelled_table(spark)), "doc_id", "spans") == expected


@given(st.lists(st.lists(st.integers(1, 40), max_size=60), min_size=1, max_size=6), st.integers(0, 2**32))
@settings(max_examples=100, deadline=None)
def test_parted_texts_are_decoded_as_whole_ones(field, texts, seed):
    random_ = np.random.default_rng(seed)
    texts = [np.where(random_.random(len(t)) < 0.7, field.shapes["plain"], np.array(t, dtype=int)) for t in texts]
    found = pii.states_of(field, np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    whole = [field.decode(t[None], np.array([len(t)]))[0] for t in texts if len(t)]
    assert found.tolist() == [state for states in whole for state in states.tolist()]


@pytest.mark.parametrize("before", [3, 511, 512, 1023, 5000])
def test_spans_in_long_runs_of_numbers(field, before):
    text = "12 " * before + "(555) 010-1234" + " 12" * 40
    assert pii.added_spans(field, *scan.text_bytes(pa.array([text]))) == {0: [("phone", 3 * before, 3 * before + 14)]}


# ---- 4 quality ------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = by_key(queries.op4_quality(spark, folder), "doc_id", "held_out", "score", "predicted")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(held == quality.is_held_out(key) for key, (held, _, _) in found.items())
    held = [(labels[key], score, predicted) for key, (out, score, predicted) in found.items() if out and key in labels]
    assert len(held) > 50 and np.mean([label == predicted for label, _, predicted in held]) > 0.97
    assert all(0 <= score <= 1 and (score >= 0.7) == bool(predicted) for _, score, predicted in held)


def test_quality_of_odd_texts(spark, docs, rows, nothing, keyless):
    labels = spark.createDataFrame([(k, n % 2) for n, (k, _) in enumerate(rows)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model)
    assert scored.count() == len(rows) and set(scored.columns) == {*docs.columns, "predicted"}
    assert scored.filter("score IS NULL OR isnan(score) OR score NOT BETWEEN 0 AND 1").count() == 0
    assert quality.score(nothing, model).count() == 0 and quality.score(keyless, model).count() == 8
    one_class = quality.fit(docs, labels.filter("quality = 1"))
    assert np.isfinite(one_class.scores(np.zeros((2, len(quality.STATISTICS))))).all()
    assert quality.fit(nothing, labels).scores(np.ones((3, len(quality.STATISTICS)))) == pytest.approx([1, 1, 1])


def test_recall_of_good_documents_by_length(spark):
    folder = "/root/testdata/sf0.01"
    found = by_key(queries.op4_quality(spark, folder).filter("held_out"), "doc_id", "predicted")
    good = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").select("doc_id")
    sizes = spark.read.parquet(f"{folder}/documents.parquet").join(good, "doc_id").selectExpr("doc_id", "char_length(text) AS size")
    taken = [found[row.doc_id][0] for row in sizes.orderBy("size").collect() if row.doc_id in found]
    assert len(taken) > 50 and all(np.mean(some) > 0.95 for some in np.array_split(taken, 4))


def test_scores_are_as_sure_as_the_labels_allow(spark):
    """Classes that overlap: independent statistics keep their odds, and copies of one share them."""
    random_ = np.random.default_rng(12)
    width = len(quality.STATISTICS)
    labels = np.arange(2000) % 2
    alone = random_.normal(labels[:, None], 1, (2000, width))
    copies = np.repeat(random_.normal(2 * labels[:, None], 1, (2000, 1)), width, axis=1) + random_.normal(0, 0.1, (2000, width))
    scales = []
    for vectors in (alone, copies):
        ones = np.hstack([np.ones((2000, 1)), vectors])
        model = quality.model_of(np.stack([ones[labels == c].T @ ones[labels == c] for c in (0, 1)]))
        known = spark.createDataFrame(list(zip(vectors.tolist(), labels.tolist())), "vector array<double>, label int")
        model = quality.scaled(model, known)
        scores = model.scores(vectors)
        scales.append(model.scale)
        sure = scores >= 0.7
        assert np.mean(labels[sure]) == pytest.approx(np.mean(scores[sure]), abs=0.03)
        # at best 0.98 and 0.72
        assert np.mean(sure[labels == 1]) > (0.95, 0.65)[len(scales) - 1]
    assert scales[0] > 0.8


def test_repeated_lines():
    texts = ["the cat\nthe dog\nthe end", "a b\n\nc d", "a b\nc d\na  b\na b c", "end\n\n", "\n\n\n", "", "x"]
    place = quality.STATISTICS.index("repeated_lines")
    vectors = quality.statistics(*scan.text_bytes(pa.array(texts)))
    assert np.sin(vectors[:, place]) ** 2 == pytest.approx([0, 0, 1 / 4, 0, 2 / 3, 0, 0])
    for text, vector in zip(texts, vectors):
        for others in ([], ["end of another"], ["x\n", "", "\n"]):
            found = quality.statistics(*scan.text_bytes(pa.array([text, *others])))
            assert found[0].tolist() == vector.tolist()


def test_distances_are_those_of_the_covariances():
    random_ = np.random.default_rng(4)
    width = len(quality.STATISTICS)
    vectors = [random_.normal(c, 1 + c, (500, width)) for c in (0, 1)]
    ones = [np.hstack([np.ones((500, 1)), v]) for v in vectors]
    model = quality.model_of(np.stack([o.T @ o for o in ones]))
    for c in (0, 1):
        covariance = np.linalg.inv(model.factors[c] @ model.factors[c].T)
        gap = vectors[c][:5] - model.means[c]
        assert ((gap @ model.factors[c]) ** 2).sum(1) == pytest.approx(np.einsum("ij,jk,ik->i", gap, np.linalg.inv(covariance), gap))
        assert model.log_dets[c] == pytest.approx(np.linalg.slogdet(covariance)[1])


# ---- 5 substrings ---------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1_500_000, 60, 7])
def test_substrings(docs, rows, size, monkeypatch):
    """Small groups force every depth of prefixes, and windows that fill a group by themselves."""
    monkeypatch.setattr(substrings, "max", min, raising=False)
    expected = brute.repeats_removed(rows)
    found = substrings.remove_repeats(docs, group_suffixes=size)
    assert {r.doc_id: (r.n_words, r.n_removed, brute.sha256(r.kept_text)) for r in found.collect()} == expected
    assert sum(removed for _, removed, _ in expected.values()) > 100


def test_substrings_of_odd_tables(nothing, keyless, docs, rows):
    assert substrings.remove_repeats(nothing).count() == 0
    found = substrings.remove_repeats(keyless, window=3).collect()
    assert len(found) == 8 and all(r.n_removed == 0 for r in found)
    short = {r.doc_id: (r.n_words, r.n_removed, brute.sha256(r.kept_text)) for r in substrings.remove_repeats(docs, window=2).collect()}
    assert short == brute.repeats_removed(rows, 2)


# ---- 6 packing ------------------------------------------------------------------------------


def test_packing(docs, rows, nothing, keyless):
    pieces = packing.pack(docs, WORD).collect()
    sequences = {}
    for key, text in rows:
        ids = library(WORD).encode(text or "", add_special_tokens=False).ids + [2]
        own, at = sorted((p for p in pieces if p.doc_id == key), key=lambda p: p.start), 0
        assert {p.doc_tokens for p in own} == {len(ids)}
        for p in own:
            assert p.start == at and p.length <= 4096 and p.length & (p.length - 1) == 0 and p.offset == 0
            assert p.ids_crc32 == brute.crc_of_ids(ids[at : at + p.length])
            assert sequences.setdefault(p.sequence_id, p) is p
            at += p.length
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(pieces)))
    lengths = [sequences[n].length for n in range(len(pieces))]
    assert lengths == sorted(lengths, reverse=True)
    assert packing.pack(nothing, WORD).count() == 0
    assert packing.pack(keyless, WORD).select("sequence_id").distinct().count() == packing.pack(keyless, WORD).count() > 8


def test_lengths():
    assert packing.lengths_of(2 * 4096 + 5) == [4096, 4096, 4, 1] and packing.lengths_of(4095)[0] == 2048
    assert packing.lengths_of(4096) == [4096] and packing.lengths_of(1) == [1]


# ---- 7 near copies --------------------------------------------------------------------------


@pytest.mark.parametrize("block", [256, 3])
def test_near_copies(docs, rows, block, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    found = by_key(near_copies.near_copy_groups(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert found == brute.near_groups(rows)
    assert sum(not kept for _, _, kept in found.values()) > 8


def test_copies_linked_by_a_common_original_alone(spark):
    """The original has not the smallest key, and no copy is near another."""
    r = random.Random(8)
    original = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = [(50, " ".join(original))]
    for copy in range(12):
        changed = list(original)
        for place in r.sample(range(2, 398, 5), 11):
            changed[place] = f"c{copy}p{place}"
        rows.append((copy, " ".join(changed)))
    expected = brute.near_groups(rows)
    pair = {k: brute.shingles_of(t) for k, t in rows}
    assert len(pair[0] & pair[1]) < 0.75 * len(pair[0] | pair[1]) and {c for _, c, _ in expected.values()} == {0}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_key(near_copies.near_copy_groups(df), "doc_id", "n_shingles", "component_id", "kept") == expected


def test_near_copies_of_odd_tables(nothing, keyless):
    assert near_copies.near_copy_groups(nothing).count() == 0
    found = near_copies.near_copy_groups(keyless).collect()
    assert len(found) == 8 and all(r.kept for r in found)
    assert all(r.component_id == r.doc_id for r in found)


def test_signatures_estimate_the_similarity():
    random_ = np.random.default_rng(6)
    gaps = []
    for _ in range(40):
        pool = random_.integers(0, 2**64, 500, dtype=np.uint64)
        one, two = pool[:400], pool[100:]
        gaps.append((near_copies.signature(one) == near_copies.signature(two)).mean() - 300 / 500)
    assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.05


# ---- 8 archives -----------------------------------------------------------------------------


def test_archives(spark):
    pages = [(5, "http://a/ b", "<p>é</p>"), (2, None, "<p>é</p>"), (9, "http://c", None), (1, "", ""), (7, "http://d", "x\r\n\r\nWARC/1.1\n"), (8, "http://d", "unlike")]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, digest string")
    found = by_key(archive.archived(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert found == brute.archived([(k, h) for k, _, h in pages])
    kept = by_key(archive.archived(df, least_bytes=5), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert kept == brute.archived([(k, h) for k, _, h in pages], 5)
    assert archive.archived(df.limit(0)).count() == 0
    doubled = archive.archived(df.filter("page_id = 5").union(df.filter("page_id = 5"))).collect()
    assert [r.record_type for r in doubled] == ["response", "response"]
    keyless = archive.archived(df.selectExpr("CAST(NULL AS long) AS page_id", "url", "html")).collect()
    assert len(keyless) == 6 and {r.record_type for r in keyless} == {"response"}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_lines_by_version(version):
    data = archive.arc_version_record(version) + b"\n"
    data += archive.arc_record(version, "http://a/", "text/html", b"head\r\n\r\nbody\nmore") + b"\n"
    (fields, block), = archive.arc_records(data)
    assert list(fields) == archive.COLUMNS[version].split() and block.endswith(b"more")
    assert fields["URL"] == "http://a/" and fields["Archive-date"] == archive.DATE
    with pytest.raises(ValueError, match="fields"):
        list(archive.arc_records(archive.arc_version_record(version) + b"\nhttp://a/ b text/html 0\n\n"))
    with pytest.raises(ValueError, match="cut off"):
        list(archive.arc_records(data[:-4]))


def test_warc_files_hold_what_the_format_asks(spark, tmp_path):
    folder = str(tmp_path / "arc")
    df = spark.createDataFrame([(1, "http://a", "same"), (2, "http://b", "same")], "page_id long, url string, html string").coalesce(1)
    archive.write_arc(df, folder, 1)
    archive.convert(spark, folder, str(tmp_path / "warc"))
    records = []
    for row in spark.read.format("binaryFile").load(str(tmp_path / "warc")).filter("length > 0").collect():
        records += list(archive.warc_records(archive._unpacked(pa.scalar(bytes(row.content)))))
    by_type = {fields["warc-type"]: (fields, block) for fields, block in records}
    fields, block = by_type["revisit"]
    assert fields["warc-refers-to"] == by_type["response"][0]["warc-record-id"]
    assert fields["warc-date"] == "2024-01-01T00:00:00Z" and not block.endswith(b"same")
    assert by_type["response"][1].endswith(b"\r\n\r\nsame")


# ---- 9 token files --------------------------------------------------------------------------


@pytest.mark.parametrize("segment", [2_000_000, 50])
def test_token_files(spark, docs, rows, nothing, keyless, segment):
    def there_and_back(df):
        folder = new_folder(spark, "tokens")
        token_files.write_token_files(df, folder, BYTE, segment_ids=segment)
        return token_files.read_token_files(spark, folder)

    expected, start = {}, 0
    for key, text in sorted(rows):
        ids = library(BYTE).encode(text or "", add_special_tokens=False).ids + [2]
        expected[key] = (start, len(ids), brute.crc_of_ids(ids))
        start += len(ids)
    assert by_key(there_and_back(docs), "doc_id", "start", "n_tokens", "ids_crc32") == expected
    assert there_and_back(nothing).count() == 0 and there_and_back(keyless).count() == 8


# ---- 10 lines -------------------------------------------------------------------------------


def test_lines(docs, rows, nothing, keyless):
    found = by_key(lines.dedup_lines(docs), "doc_id", "n_lines", "n_removed", "kept_text")
    assert found == brute.lines_deduped(rows)
    assert sum(removed for _, removed, _ in found.values()) > 6
    kept = lines.kept_lines(docs)
    assert set(kept.columns) == {*docs.columns, "n_removed"} - {"text"} and kept.count() == len(rows)
    assert lines.dedup_lines(nothing).count() == 0
    odd = lines.dedup_lines(keyless).collect()
    assert len(odd) == 8 and all(r.n_removed == 0 for r in odd)
