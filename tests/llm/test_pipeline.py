"""The pipeline against the same stages done plainly, one document after another."""

import brute
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from parcelworks.llm import packing, quality, queries

FOLDER = "/root/testdata/sf0.001"


def _plain(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = quality.score(frame.select("doc_id", "text"), queries.quality_model(spark, frame, FOLDER))
    good = {r.doc_id for r in scored.filter("predicted = 1").select("doc_id").collect()}
    kept = [(k, t) for k, t in docs.items() if k in good]
    lines = brute.lines_deduped(kept)
    kept = [(k, text) for k, (n, gone, text) in lines.items() if n == 0 or gone < n]
    groups = brute.near_groups(kept)
    kept = [(k, t) for k, t in kept if groups[k][2]]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    return docs, good, [(k, t) for k, t in kept if not any(item in " ".join((t or "").lower().split()) for item in items)]


def test_pipeline(spark):
    docs, good, kept = _plain(spark)
    assert len(good) < len(docs) and len(kept) < len(good)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    expected = set()
    for key, text in kept:
        ids, at = library.encode(text or "", add_special_tokens=False).ids + [2], 0
        for length in packing.lengths_of(len(ids)):
            expected.add((key, at, length, brute.crc_of_ids(ids[at : at + length]), len(ids)))
            at += length
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces} == expected
    assert sorted(p.sequence_id for p in pieces) == list(range(len(pieces))) and len(pieces) == len(expected)


def test_stages_take_odd_and_empty_tables(spark, docs, nothing, keyless):
    for frame in (docs, nothing, keyless):
        given = frame
        for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
            given = stage(spark, given, FOLDER)
            if place < len(corpus_pipeline.STAGES) - 1:
                assert given.columns == list(corpus_pipeline.COLUMNS)
        given.collect()


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "near copies", "benchmark decontamination", "packing",
    ]


def test_lines_agree_with_sql(spark):
    from compare import database, differences

    assert differences(queries.op10_lines(spark, FOLDER), database(FOLDER), queries.ORACLE["op10_lines"]) == []
