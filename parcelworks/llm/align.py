"""Alignment of two tokenizers' ids over a corpus, by inverted bitmaps of id pairs.

Tokenizer A is a byte-level vocabulary, B a piece vocabulary with byte fallback. Byte offsets where
tokens of both end cut a text into groups; every A token of a group is linked with every B token of
it. Texts are encoded word by word: neither vocabulary merges across a single space or line feed,
so a word's ids, groups and links are worked out once for a slice and looked up after that.

Documents are numbered within blocks. For each pair of ids a block holds a bitmap of the documents
that have it linked, and bitmaps ("planes") of the bits of how many times more than once they have
it; rare ones are lists of places, frequent ones bit by bit, all compressed. Pairs are dealt to
buckets by their A id. Popcounts of the document bitmaps, added over the blocks, are the pairs'
document counts, and those of the planes the link counts; the highest count of an A id is found
within its bucket. The postings then take the scores back: the bitmaps meet the counts of their
bucket, and each document adds up what its places hold. A frequent pair is a bit per document.
"""

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.groups import stored
from parcelworks.llm.ordering import partitions
from parcelworks.llm.scan import Words, batch_of, mixed, slices, text_bytes, text_list
from parcelworks.llm.tokens import BEHIND_FEED, Encoder, odd_texts, text_starts, texts_with, word_kinds
from parcelworks.llm.word_table import WordTable

#: a key holds the bucket, the A id, the B id and the document's place in its block
ID_BITS, PLACE_BITS, BUCKET_BITS = 20, 16, 7
BUCKETS = 1 << BUCKET_BITS
#: a block is closed at so many links or documents
BLOCK_LINKS, BLOCK_DOCUMENTS = 2_000_000, 60_000
#: pairs whose counts a task holds, and bytes of bitmaps that it gets
TASK_PAIRS, TASK_BYTES = 1_000_000, 24_000_000


class Tokenizers:
    """Both vocabularies, and the links within words."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.one = Encoder(byte_path, kept_words=1)
        self.two = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        places = {letter: byte for byte, letter in self.one.letters.items()}
        vocabulary = self.one.tokenizer.get_vocab()
        if max(len(vocabulary), self.two.get_piece_size()) >> ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        self.sizes_a = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            # special tokens are not spelled in byte letters; no text is encoded to them
            self.sizes_a[number] = len(token) if all(letter in places for letter in token) else 0
        pieces = range(self.two.get_piece_size())
        self.bytes_b = [
            bytes([int(self.two.id_to_piece(i)[3:5], 16)]) if self.two.is_byte(i)
            else self.two.id_to_piece(i).replace("▁", " ").encode("utf-8")
            for i in pieces
        ]
        self.sizes_b = np.array([len(piece) for piece in self.bytes_b])
        self.spaced_b = np.array([piece[:1] == b" " for piece in self.bytes_b])
        self.feed_b = self.two.piece_to_id("<0x0A>")
        self.bucket = (mixed(np.arange(1 << ID_BITS, dtype=np.uint64)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        self.table = WordTable(self.words, [np.int64, np.uint8, np.int64])

    def words(self, words: list[bytes], kind: int) -> Iterator[tuple]:
        """Per word with its space or line feed: links as keys, its groups as text, and its sizes."""
        # a word with the sign for a space in it does not come back from pieces
        usable = [place for place, word in enumerate(words) if b"\xe2\x96\x81" not in word]
        for places, ((ids_a, sizes),) in self.one.spaced([words[place] for place in usable], kind):
            some = [words[usable[place]] for place in places.tolist()]
            before = b"\n" if kind == BEHIND_FEED else b" "
            text = before + before.join(some)
            ids_b = np.array(self._pieces(text, kind), dtype=np.int64)
            starts = np.flatnonzero(ids_b == self.feed_b if kind == BEHIND_FEED else self.spaced_b[ids_b])
            if len(starts) != len(some) or b"".join([self.bytes_b[i] for i in ids_b.tolist()]) != text:
                # one that is not as given spoils its neighbours only here: go on with each half
                if len(some) > 1:
                    halves = places[: len(places) // 2], places[len(places) // 2 :]
                    for half in halves:
                        own = [usable[place] for place in half.tolist()]
                        for inner, runs in self.words([words[place] for place in own], kind):
                            yield np.array(own)[inner], runs
                continue
            groups = Groups(self, ids_a.astype(np.int64), ids_b)
            per_word = groups.per_run(np.cumsum(sizes) - sizes, starts)
            yield np.array(usable)[places], per_word

    def _pieces(self, text: bytes, kind: int) -> list[int]:
        if kind == BEHIND_FEED:
            # a text begins with the sign for a space, which is no part of this one
            return self.two.encode(text.decode("utf-8"), num_threads=1)[1:]
        return self.two.encode(text[1:].decode("utf-8"), num_threads=1)

    def whole(self, text: bytes) -> "Groups | None":
        """The groups of a whole text; None if it has no tokens."""
        if not text:
            return None
        spelled = text.decode("utf-8")
        ids_b = self.two.encode(spelled, num_threads=1)
        if b"".join([self.bytes_b[i] for i in ids_b]) != b" " + text:
            return None
        ids_a = self.one.whole(" " + spelled).astype(np.int64)
        if self.sizes_a[ids_a].sum() != len(text) + 1:
            return None
        return Groups(self, ids_a, np.array(ids_b, dtype=np.int64))


class Groups:
    """Ids of one byte string in both vocabularies, cut where tokens of both end."""

    def __init__(self, tokenizers: Tokenizers, ids_a: np.ndarray, ids_b: np.ndarray):
        self.a, self.b, self.bucket = ids_a, ids_b, tokenizers.bucket
        ends_a, ends_b = np.cumsum(tokenizers.sizes_a[ids_a]), np.cumsum(tokenizers.sizes_b[ids_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        #: where each group's tokens end
        self.end_a = np.searchsorted(ends_a, common, "right")
        self.end_b = np.searchsorted(ends_b, common, "right")
        self.start_a = np.concatenate([[0], self.end_a[:-1]])
        self.start_b = np.concatenate([[0], self.end_b[:-1]])

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The links as keys of pairs, group by group, and how many each group has."""
        n_a, n_b = self.end_a - self.start_a, self.end_b - self.start_b
        links = n_a * n_b
        group = np.repeat(np.arange(len(links)), links)
        at = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        a = self.a[self.start_a[group] + at // n_b[group]]
        b = self.b[self.start_b[group] + at % n_b[group]]
        return (((self.bucket[a] << ID_BITS | a) << ID_BITS) | b) << PLACE_BITS, links

    def texts(self) -> list[str]:
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        edges = zip(self.start_a.tolist(), self.end_a.tolist(), self.start_b.tolist(), self.end_b.tolist())
        return [",".join(a[i:j]) + "|" + ",".join(b[k:n]) for i, j, k, n in edges]

    def per_run(self, starts_a: np.ndarray, starts_b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Keys, text and sizes (A, B, groups) of each run of tokens; runs begin with groups."""
        keys, links = self.keys()
        first = np.searchsorted(self.start_a, starts_a)
        n_groups = np.diff(np.append(first, len(links)))
        n_links = np.add.reduceat(links, first)
        texts = self.texts()
        cuts = np.append(first, len(links)).tolist()
        joined = [(";".join(texts[i:j]) + ";").encode("ascii") for i, j in zip(cuts[:-1], cuts[1:])]
        n_a, n_b = np.diff(np.append(starts_a, len(self.a))), np.diff(np.append(starts_b, len(self.b)))
        return [
            (keys, n_links),
            (np.frombuffer(b"".join(joined), dtype=np.uint8), np.array(list(map(len, joined)))),
            (np.stack([n_a, n_b, n_groups], axis=1).ravel(), np.full(len(first), 3)),
        ]


_tokenizers: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(byte_path: str, piece_path: str) -> Tokenizers:
    """One pair per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (byte_path, piece_path) not in _tokenizers:
        _tokenizers[byte_path, piece_path] = Tokenizers(byte_path, piece_path)
    return _tokenizers[byte_path, piece_path]


# ---- bitmaps --------------------------------------------------------------------------------


def _pack_plane(pair: np.ndarray, place: np.ndarray, n_pairs: int, n_places: int) -> list[np.ndarray]:
    """A bitmap per pair: how many places if they are listed, else the bits; 65535 marks the latter."""
    counts = np.bincount(pair, minlength=n_pairs)
    dense = counts * 16 > n_places
    rows = np.cumsum(dense) - 1
    bits = np.zeros((int(dense.sum()), n_places), dtype=bool)
    of_dense = dense[pair]
    bits[rows[pair[of_dense]], place[of_dense]] = True
    return [
        np.where(dense, 65_535, counts).astype("<u2"),
        place[~of_dense].astype("<u2"),
        np.packbits(bits, axis=1).ravel(),
    ]


def pack_bitmaps(pairs: np.ndarray, pair: np.ndarray, place: np.ndarray, times: np.ndarray, n_places: int) -> bytes:
    """Document bitmaps and multiplicity planes of ascending ``pairs``, from (pair, place, times) in order."""
    planes = [_pack_plane(pair, place, len(pairs), n_places)]
    more = times - 1
    while more.any():
        odd = (more & 1).astype(bool)
        planes.append(_pack_plane(pair[odd], place[odd], len(pairs), n_places))
        more = more >> 1
    arrays = [np.diff(pairs, prepend=0).astype("<i8")] + [values for plane in planes for values in plane]
    body = b"".join(values.tobytes() for values in arrays)
    head = np.array([len(body), n_places, len(pairs), len(planes), *[len(p) for plane in planes for p in plane]], dtype="<i8")
    return len(head).to_bytes(2, "little") + head.tobytes() + pa.compress(body, "zstd", asbytes=True)


class Bitmaps:
    """Unpacked bitmaps: the pairs, and for the document bitmap and each plane its places."""

    def __init__(self, data: bytes):
        n = int.from_bytes(data[:2], "little")
        size, self.n_places, n_pairs, n_planes, *lengths = np.frombuffer(data, "<i8", n, 2).tolist()
        body = pa.decompress(data[2 + 8 * n :], size, "zstd", asbytes=True)
        self.pairs = np.cumsum(np.frombuffer(body, "<i8", n_pairs))
        at, self.planes = 8 * n_pairs, []
        for plane in range(n_planes):
            n_counts, n_listed, n_bits = lengths[3 * plane : 3 * plane + 3]
            counts = np.frombuffer(body, "<u2", n_counts, at)
            listed = np.frombuffer(body, "<u2", n_listed, at + 2 * n_counts)
            bits = np.frombuffer(body, "u1", n_bits, at + 2 * (n_counts + n_listed))
            at += 2 * (n_counts + n_listed) + n_bits
            self.planes.append((counts, listed, bits.reshape(-1, -(-self.n_places // 8))))

    def popcounts(self, plane: int) -> np.ndarray:
        counts, _, bits = self.planes[plane]
        found = counts.astype(np.int64)
        found[counts == 65_535] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        return found

    def documents(self) -> np.ndarray:
        return self.popcounts(0)

    def links(self) -> np.ndarray:
        return self.popcounts(0) + sum(self.popcounts(k) << (k - 1) for k in range(1, len(self.planes)))

    def postings(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(pair, place, weight): a document's links of a pair are the sum of the weights."""
        for number, (counts, listed, bits) in enumerate(self.planes):
            dense = np.flatnonzero(counts == 65_535)
            row, place = np.nonzero(np.unpackbits(bits, axis=1, count=self.n_places)) if len(dense) else (dense, dense)
            pair = np.repeat(np.arange(len(counts)), np.where(counts == 65_535, 0, counts))
            weight = 1 << max(0, number - 1)
            yield np.concatenate([pair, dense[row]]), np.concatenate([listed.astype(np.int64), place]), weight


# ---- encoding -------------------------------------------------------------------------------

ENCODED_SQL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "bucket int, block long, data binary"
)
ENCODED = pa.schema(
    [(name, pa.int64()) for name in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("bucket", pa.int32()), ("block", pa.int64()), ("data", pa.binary())]
)
DOCUMENT, BITMAP = ENCODED.names[:7], ENCODED.names[7:]


def _partly(names: list[str], size: int, **columns) -> pa.RecordBatch:
    empty = {name: pa.nulls(size, ENCODED.field(name).type) for name in ENCODED.names if name not in names}
    return batch_of(ENCODED, **columns, **empty)


def _sliced(tokenizers: Tokenizers, column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Of each text of a slice: sizes (A, B, groups, links) and digest; the links' keys and texts."""
    data, offsets = text_bytes(column)
    odd = odd_texts(data, offsets)
    plain = np.flatnonzero(~odd)
    words = Words(*(text_bytes(column.take(pa.array(plain))) if odd.any() else (data, offsets)))
    kinds = word_kinds(words)
    kinds[text_starts(words)] = 0
    entries = tokenizers.table.entries(words, kinds)
    odd[plain[texts_with(words, entries < 0)]] = True
    # words of texts that are encoded whole take no part
    usable = np.repeat(~odd[plain], np.diff(words.bounds))
    text_of = np.repeat(plain, np.diff(words.bounds))[usable]
    entries = entries[usable]
    sizes, digests = np.zeros((len(column), 4), dtype=np.int64), [""] * len(column)
    keys, counts = tokenizers.table.columns[0].take(entries)
    spelled, lengths = tokenizers.table.columns[1].take(entries)
    three = tokenizers.table.columns[2].take(entries)[0].reshape(-1, 3)
    edges = np.searchsorted(text_of, np.arange(len(column) + 1))
    for place, values in enumerate([*three.T, counts]):
        sizes[:, place] = np.diff(np.concatenate([[0], np.cumsum(values)])[edges])
    cuts = np.concatenate([[0], np.cumsum(lengths)])[edges].tolist()
    packed = memoryview(spelled.tobytes())
    for place, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            digests[place] = hashlib.sha256(packed[a : b - 1]).hexdigest()
    parts, texts = [keys], [np.repeat(text_of, counts)]
    if odd.any():
        raw = text_list(column)
        for place in np.flatnonzero(odd).tolist():
            groups = tokenizers.whole(raw[place])
            if groups is not None:
                own, links = groups.keys()
                sizes[place] = len(groups.a), len(groups.b), len(links), len(own)
                digests[place] = hashlib.sha256(";".join(groups.texts()).encode("ascii")).hexdigest()
                parts.append(own)
                texts.append(np.full(len(own), place))
    return sizes, digests, np.concatenate(parts), np.concatenate(texts)


def _encoded_rows(byte_path: str, piece_path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizers = tokenizers_of(byte_path, piece_path)
        block, places, held, n_links = TaskContext.get().partitionId() << 24, 0, [], 0

        def closed() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held)
            held.clear()
            keys.sort()
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            times = np.diff(np.append(first, len(keys)))
            keys = keys[first]
            pair, place = keys >> PLACE_BITS, keys & ((1 << PLACE_BITS) - 1)
            cuts = np.searchsorted(pair >> (2 * ID_BITS), np.arange(BUCKETS + 1))
            buckets, packed = [], []
            for bucket, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if b > a:
                    pairs, number = np.unique(pair[a:b], return_inverse=True)
                    buckets.append(bucket)
                    packed.append(pack_bitmaps(pairs, number, place[a:b], times[a:b], places))
            for at in range(0, len(buckets), 16):
                some = buckets[at : at + 16]
                yield _partly(BITMAP, len(some), bucket=some, block=[block] * len(some), data=packed[at : at + 16])

        for batch in batches:
            for part in slices(batch):
                for at in range(0, len(part), BLOCK_DOCUMENTS):
                    some = part.slice(at, BLOCK_DOCUMENTS)
                    if held and places + len(some) > BLOCK_DOCUMENTS:
                        yield from closed()
                        block, places, n_links = block + 1, 0, 0
                    sizes, digests, keys, texts = _sliced(tokenizers, some.column("text"))
                    yield _partly(
                        DOCUMENT, len(some), row=(block << PLACE_BITS) + places + np.arange(len(some)),
                        doc_id=some.column("doc_id"), groups_sha256=digests,
                        **dict(zip(("n_a", "n_b", "n_groups", "n_links"), sizes.T)),
                    )
                    held.append(keys | (places + texts))
                    places += len(some)
                    n_links += len(keys)
                    if n_links >= BLOCK_LINKS or places >= BLOCK_DOCUMENTS:
                        yield from closed()
                        block, places, n_links = block + 1, 0, 0
        if held:
            yield from closed()

    return rows


def encoded(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of documents and rows of bitmaps, stored: texts are encoded once."""
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    return stored(narrow.mapInArrow(_encoded_rows(byte_path, piece_path), ENCODED_SQL), "aligned")


# ---- counts ---------------------------------------------------------------------------------

COUNTS_SQL = "bucket int, pairs binary, documents binary, links binary"
COUNTS = pa.schema([("bucket", pa.int32()), ("pairs", pa.binary()), ("documents", pa.binary()), ("links", pa.binary())])


def _added(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal pairs added up; pairs ascend."""
    pairs, inverse = np.unique(np.concatenate([part[0] for part in parts]), return_inverse=True)
    sums = []
    for place in (1, 2):
        total = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(total, inverse, np.concatenate([part[place] for part in parts]))
        sums.append(total)
    return pairs, *sums


class _Sums:
    """Counts per bucket, added up whenever ``most`` have come together."""

    def __init__(self, most: int = 2_000_000):
        self.most, self.parts, self.held = most, {}, 0

    def add(self, bucket: int, part: tuple) -> bool:
        """Whether so many different pairs are held that they should be passed on."""
        self.parts.setdefault(bucket, []).append(part)
        self.held += len(part[0])
        if self.held > self.most:
            self.parts = {bucket: [_added(some)] for bucket, some in self.parts.items()}
            self.held = sum(len(some[0][0]) for some in self.parts.values())
        return 2 * self.held > self.most

    def rows(self) -> Iterator[pa.RecordBatch]:
        for bucket, some in sorted(self.parts.items()):
            pairs, documents, links = (values.astype("<i8").tobytes() for values in _added(some))
            yield batch_of(COUNTS, bucket=[bucket], pairs=[pairs], documents=[documents], links=[links])
        self.parts, self.held = {}, 0


def _popcount_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = _Sums()
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
            bitmaps = Bitmaps(data.as_py())
            if sums.add(bucket, (bitmaps.pairs, bitmaps.documents(), bitmaps.links())):
                yield from sums.rows()
    yield from sums.rows()


def _summed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by bucket: one bucket's pairs are held, of which there are no more than pairs of ids."""
    sums, last = _Sums(), None
    for batch in batches:
        for row in batch.to_pylist():
            if last is not None and row["bucket"] != last:
                yield from sums.rows()
            last = row["bucket"]
            sums.add(last, tuple(np.frombuffer(row[name], "<i8") for name in COUNTS.names[1:]))
    yield from sums.rows()


def pair_counts(encoded: DataFrame) -> DataFrame:
    """One row per bucket: its pairs in ascending order, their document counts and their link counts."""
    spark = encoded.sparkSession
    bitmaps = encoded.filter("bucket IS NOT NULL").select("bucket", "data")
    partial = bitmaps.mapInArrow(_popcount_rows, COUNTS_SQL)
    # two steps, so that no task gets a row from every task
    slots = max(1, int(partitions(spark) ** 0.5))
    half = partial.withColumn("slot", F.expr(f"pmod(spark_partition_id(), {slots})"))
    half = half.repartition(F.col("bucket"), F.col("slot")).drop("slot").sortWithinPartitions("bucket")
    whole = half.mapInArrow(_summed_rows, COUNTS_SQL).repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return stored(whole.mapInArrow(_summed_rows, COUNTS_SQL), "pair-counts")


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(name, pa.int64()) for name in ("a", "b", "documents", "links")])
    mask = (1 << ID_BITS) - 1
    for batch in batches:
        for row in batch.to_pylist():
            pairs, documents, links = (np.frombuffer(row[name], "<i8") for name in COUNTS.names[1:])
            for at in range(0, len(pairs), 100_000):
                some = slice(at, at + 100_000)
                yield batch_of(
                    schema, a=(pairs[some] >> ID_BITS) & mask, b=pairs[some] & mask, documents=documents[some], links=links[some]
                )


def pair_table(counts: DataFrame) -> DataFrame:
    """(a, b, documents, links) of every pair of ids that is linked somewhere."""
    return counts.mapInArrow(_pair_rows, "a long, b long, documents long, links long")


# ---- scores ---------------------------------------------------------------------------------


def _score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document, from rows of counts followed by rows of bitmaps ordered by block."""
    schema = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
    known: dict[int, tuple] = {}
    block, sums = None, np.zeros((2, 0), dtype=np.int64)

    def closed() -> Iterator[pa.RecordBatch]:
        there = np.flatnonzero(sums.any(axis=0))
        if len(there):
            yield batch_of(schema, row=(block << PLACE_BITS) + there, n_best=sums[0, there], count_sum=sums[1, there])

    for batch in batches:
        for place in range(len(batch)):
            row = {name: batch.column(name)[place].as_py() for name in batch.schema.names}
            if row["block"] < 0:
                pairs, counts = np.frombuffer(row["data"], "<i8"), np.frombuffer(row["documents"], "<i8")
                a = pairs >> ID_BITS
                first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(a))))
                known[row["bucket"]] = pairs, counts, counts == highest
                continue
            if row["block"] != block:
                if block is not None:
                    yield from closed()
                block, sums = row["block"], np.zeros((2, 1 << PLACE_BITS), dtype=np.int64)
            bitmaps = Bitmaps(row["data"])
            pairs, counts, best = known[row["bucket"]]
            at = np.searchsorted(pairs, bitmaps.pairs)
            for pair, document, weight in bitmaps.postings():
                n = counts[at[pair]]
                # sums of doubles stay exact: a plane has fewer than 2**26 postings
                for part, factor in ((n & (1 << 26) - 1, 1), (n >> 26, 1 << 26)):
                    added = np.bincount(document, weights=part).astype(np.int64)
                    sums[1, : len(added)] += added * factor * weight
                added = np.bincount(document[best[at[pair]]])
                sums[0, : len(added)] += added * weight
    if block is not None:
        yield from closed()


def document_scores(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of the documents that have links.

    Buckets meet in groups of about a million pairs, and the blocks of a group in shares, so a task
    holds the counts of one group and gets a bounded share of the bitmaps.
    """
    spark = encoded.sparkSession
    bitmaps = encoded.filter("bucket IS NOT NULL").select("bucket", "block", "data")
    # at most a row per bucket comes to the driver
    sizes = {row["bucket"]: row["n"] for row in counts.selectExpr("bucket", "length(pairs) / 8 AS n").collect()}
    group_of, group, held = {}, 0, 0
    for bucket in sorted(sizes):
        if held and held + sizes[bucket] > TASK_PAIRS:
            group, held = group + 1, 0
        group_of[bucket] = group
        held += sizes[bucket]
    size = bitmaps.selectExpr("sum(length(data)) AS size").first()["size"] or 0
    groups = group + 1
    shares = max(1, -(-size // (groups * TASK_BYTES)), -(-partitions(spark) // groups))
    of_bucket = "element_at(array({}), bucket + 1)".format(", ".join(str(group_of.get(b, 0)) for b in range(BUCKETS)))
    scored = counts.selectExpr(
        "bucket", "-1L AS block", "pairs AS data", "documents", f"explode(sequence(0, {shares - 1})) AS share"
    )
    given = bitmaps.selectExpr(
        "bucket", "block", "data", "CAST(NULL AS binary) AS documents", f"int(pmod(xxhash64(block), {shares})) AS share"
    )
    dealt = scored.union(given).withColumn("part", F.expr(f"int(({of_bucket}) * {shares} + share)"))
    met = dealt.repartitionById(groups * shares, F.col("part")).drop("part", "share").sortWithinPartitions("block", "bucket")
    sums = met.mapInArrow(_score_rows, "row long, n_best long, count_sum long")
    return sums.groupBy("row").agg(F.expr("sum(n_best) AS n_best"), F.expr("sum(count_sum) AS count_sum"))


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: tokens of both vocabularies, groups, links, and what the corpus says of the links.

    ``n_best`` counts the links whose pair is held linked by as many documents as any pair of its A
    id, ``count_sum`` adds up those document counts. A null or empty text, or one that its pieces
    do not spell, has no tokens: zeros and an empty digest. Rows without a key, or with a repeated
    one, are documents of their own. An empty table gives no row. Other columns are not read.
    """
    table = encoded(docs, byte_path, piece_path, key, text)
    scores = document_scores(table, pair_counts(table))
    documents = table.filter("row IS NOT NULL").select(*DOCUMENT)
    return documents.join(scores, "row", "left").selectExpr(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "coalesce(n_best, 0L) AS n_best",
        "coalesce(count_sum, 0L) AS count_sum", "groups_sha256",
    )
