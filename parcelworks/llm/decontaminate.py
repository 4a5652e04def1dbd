"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur with some errors: insertions, deletions and changes of characters, as many
as a share of its length. Split into one piece more than that budget, at least one piece of an
occurrence must be free of errors. So the pieces of all items are searched for exactly (one
automaton over a block of items), and around each hit Myers' bit-parallel distance decides whether
the whole item is there within its budget. Letter case and runs of white space make no difference.

Items are the query set: they go to the tasks in blocks bounded by count and by letters, each block
read against all documents; documents stay where they are, and no two of them meet. Where there is
more than one block, what a block has given is stored in the shared folder before the next one is
told to the tasks, so that no plan and no process holds more than two blocks.
"""

from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.scan import batch_of, free_name, slices
from parcelworks.sources.staging import new_folder, staged

ERROR_SHARE = 0.08
#: a block of items ends with whichever is reached first
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 8_000_000


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def budget_of(item: str, error_share: float = ERROR_SHARE) -> int:
    return int(len(item) * error_share)


def pieces_of(item: str, errors: int) -> list[tuple[int, str]]:
    """The item in ``errors + 1`` pieces of nearly equal length, each with its place."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks_of(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for place, letter in enumerate(pattern):
        masks[letter] |= 1 << place
    return dict(masks)


def nearest(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Smallest edit distance of the pattern to any substring of the text, and where that one ends.

    Myers' algorithm: a column of the distance table is two bit vectors of vertical differences,
    here in integers as long as the pattern.
    """
    masks = masks_of(pattern) if masks is None else masks
    every, last = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, score = every, 0, len(pattern)
    best, end = score, 0
    for place, letter in enumerate(text):
        equal = masks.get(letter, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus) & every
        down = plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = up << 1, down << 1
        plus = (down | ~(vertical | up)) & every
        minus = up & vertical & every
        if score < best:
            best, end = score, place + 1
    return best, end


class Matcher:
    """A block of items, (id, normalised text) each, ready to search texts for."""

    def __init__(self, items: list[tuple[int, str]], error_share: float = ERROR_SHARE):
        import ahocorasick

        self.items, self.budgets, self.masks = items, [], []
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, item) in enumerate(items):
            self.budgets.append(budget_of(item, error_share))
            self.masks.append(masks_of(item))
            for place, piece in pieces_of(item, self.budgets[-1]):
                places[piece].append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, of in places.items():
            self.automaton.add_word(piece, (len(piece), of))
        self.automaton.make_automaton()

    def regions(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the stretches of a normalised text in which an occurrence can lie, by the hits of its pieces.

        Stretches that overlap the one before are one, so a piece that hits again and again is
        looked into once, in time proportional to the text.
        """
        found: dict[int, list[list[int]]] = {}
        for at, (length, of) in self.automaton.iter(text):
            for number, place in of:
                errors = self.budgets[number]
                start = at + 1 - length - place
                begin, end = max(0, start - errors), start + len(self.items[number][1]) + errors
                known = found.setdefault(number, [])
                if known and begin <= known[-1][1]:
                    known[-1] = [min(begin, known[-1][0]), max(end, known[-1][1])]
                else:
                    known.append([begin, end])
        return found

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item number, distance, end) of each item's best occurrence within its budget, in a normalised text."""
        for number, stretches in sorted(self.regions(text).items()):
            item, errors = self.items[number][1], self.budgets[number]
            best = None
            for begin, end in stretches:
                exact = text.find(item, begin, end)
                if exact >= 0:
                    best = 0, exact + len(item)
                    break
                distance, stop = nearest(item, text[begin:end], self.masks[number])
                if distance <= errors and (best is None or distance < best[0]):
                    best = distance, begin + stop
            if best is not None:
                yield number, *best


_matchers: dict[int, Matcher] = {}


def _matcher(items: list[tuple[int, str]], error_share: float) -> Matcher:
    """One matcher of the latest block per worker process."""
    key = hash((tuple(items), error_share))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(items, error_share)
    return _matchers[key]


FOUND = pa.schema([(name, pa.int64()) for name in ("doc_id", "item_id", "distance", "end", "item_chars")])


def _found_rows(items: list[tuple[int, str]], error_share: float) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(items, error_share)
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    for number, distance, end in matcher.matches(normalised(text or "")):
                        key, item = items[number]
                        out.append((doc, key, distance, end, len(item)))
                if out:
                    yield batch_of(FOUND, **dict(zip(FOUND.names, zip(*out))))

    return rows


def _free_rows(items: list[tuple[int | None, str]], error_share: float, text_name: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(items, error_share)
        for batch in batches:
            for part in slices(batch, text_name):
                texts = part.column(text_name).to_pylist()
                free = [next(matcher.matches(normalised(text or "")), None) is None for text in texts]
                kept = part.filter(pa.array(free, pa.bool_()))
                yield kept.drop_columns([text_name])

    return rows


def blocks_of(
    benchmark: DataFrame, key: str = "item_id", text: str = "text", size: int = BLOCK_ITEMS, chars: int = BLOCK_CHARS
) -> Iterator[list[tuple[int | None, str]]]:
    """Blocks of items in the order of their keys, those without a key first; items without letters are left out.

    A block has at most ``size`` items and ``chars`` letters, or one item that is longer.
    """
    named = benchmark.select(F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(text)).alias("text"))
    block, held = [], 0
    for row in named.filter("text IS NOT NULL").orderBy("key", "text").toLocalIterator():
        item = normalised(row["text"])
        if not item:
            continue
        if block and (len(block) == size or held + len(item) > chars):
            yield block
            block, held = [], 0
        block.append((row["key"], item))
        held += len(item)
    if block:
        yield block


def _with_last(blocks: Iterator[list]) -> Iterator[tuple[list, bool]]:
    """Each block and whether it is the last."""
    block = next(blocks, None)
    while block is not None:
        following = next(blocks, None)
        yield block, following is None
        block = following


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    error_share: float = ERROR_SHARE,
    **limits: int,
) -> DataFrame:
    """(doc_id, item_id, distance, end, item_chars) per document and item that it holds.

    ``distance`` is that of the best occurrence found and ``end`` its end in the text with case
    and white space made alike. Null and empty texts hold nothing; documents without a key are
    reported without one; equal documents are reported each. Without documents or items there
    are no rows. An item without a key is reported with a null one, and items with one key each for
    themselves. An item so short that its budget is zero is found wherever it stands, in as many
    documents as hold it. Columns other than key and text are not read. ``limits`` are those of
    ``blocks_of``.
    """
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    schema = "doc_id long, item_id long, distance long, end long, item_chars long"
    path = new_folder(docs.sparkSession, "items-found")
    stored = 0
    for block, last in _with_last(blocks_of(benchmark, **limits)):
        found = narrow.mapInArrow(_found_rows(block, error_share), schema)
        if last and not stored:
            return found
        found.write.parquet(f"{path}/block={stored}")
        stored += 1
    if not stored:
        return docs.sparkSession.createDataFrame([], schema)
    return docs.sparkSession.read.schema(schema + ", block int").parquet(path).drop("block")


def without_items(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", error_share: float = ERROR_SHARE, **limits: int
) -> DataFrame:
    """The documents that hold no item, with a key or without, with all their columns, whatever their names.

    Null and empty texts hold nothing and stay; rows without a key and repeated rows are judged each
    by its text, whole however long. Without items all stay, without documents there are no rows.
    """
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema)
    given_text = free_name(docs.columns, "given_text")
    for block, last in _with_last(blocks_of(benchmark, **limits)):
        given = docs.select("*", F.col(quoted(text)).alias(given_text))
        docs = given.mapInArrow(_free_rows(block, error_share, given_text), fields)
        if not last:
            # stored by place, as names may differ in case only
            names = docs.columns
            docs = staged(docs.toDF(*[f"c{place}" for place in range(len(names))]), "free-of-items").toDF(*names)
    return docs
