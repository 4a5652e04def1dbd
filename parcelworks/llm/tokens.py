"""Exact token ids of whole texts with the tokenizers library, reusing the ids of repeated words.

Both supported vocabularies split a text before any merge, and none of their splits joins what
stands before white space with the white space or what follows it. So the ids of a text whose
words are parted by single spaces and line feeds are those of its words, each with the space or
line feed before it, and are looked up word by word (see ``word_table``). The new words of a slice
are encoded together, as one text, and its ids are parted at the words. Words of Latin letters go
straight to the library's merge model, all others through its whole chain. Any other text is
encoded whole.
"""

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from parcelworks.llm.scan import Words, text_bytes, text_list
from parcelworks.llm.word_table import LIMIT, WordTable

SPACE, LINE_FEED = ord(" "), ord("\n")
#: words that the whole chain, and the merges alone, take in one call
CALL_WORDS, MODEL_WORDS = 4096, 64
# letters that need no normalisation and that every stage takes for letters (without U+0130,
# whose lower case is no letter alone), and the marks that follow words most often
LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,]?)")
#: kinds of words: behind a space, behind a line feed
BEHIND_SPACE, BEHIND_FEED = 0, 1


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    letters, extra = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else extra))
        extra += byte not in plain
    return letters


def odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts are not words parted by one space or one line feed each; empty texts are such."""
    space = (data == SPACE) | (data == LINE_FEED)
    odd = (data >= 0x09) & (data <= 0x0D) & (data != LINE_FEED)
    odd[1:] |= space[1:] & space[:-1]
    full = offsets[1:] > offsets[:-1]
    found = ~full
    # a text's own first byte may follow another text's last
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    odd[first] = space[first] | (odd[first] & ~space[first])
    odd[last] |= space[last]
    found[full] = np.add.reduceat(odd, offsets[:-1][full]) > 0 if len(first) else False
    return found


def starts_with_space(word: bytes) -> bool:
    """Whether a word begins with white space other than the bytes that part words."""
    return word[0] <= 0x20 or word[0] >= 0xC2 and word.decode("utf-8")[0].isspace()


def word_kinds(words: Words) -> np.ndarray:
    """Whether each word stands behind a line feed; those that begin a text are taken to be behind a space."""
    feeds = words.data[np.maximum(words.starts - 1, 0)] == LINE_FEED
    feeds[text_starts(words)] = False
    return feeds.astype(np.int64)


def text_starts(words: Words) -> np.ndarray:
    """The first word of each text that has words."""
    return words.bounds[:-1][np.diff(words.bounds) > 0]


def texts_with(words: Words, chosen: np.ndarray) -> np.ndarray:
    """Which texts hold one of the chosen words."""
    return np.diff(np.concatenate([[0], np.cumsum(chosen)])[words.bounds]) > 0


class Encoder:
    """Ids of texts as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, kept_words: int = LIMIT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        with open(path, encoding="utf-8") as file:
            normalizer = json.load(file).get("normalizer")
        # one vocabulary lower-cases and drops white space, the other keeps both
        self.lowers = normalizer is not None
        self.table = WordTable(self._lowered if self.lowers else self.spaced, [np.uint32], kept_words)
        self.letters = dict(enumerate(byte_letters()))
        self.space = self.letters[SPACE]
        vocabulary = self.tokenizer.get_vocab()
        #: ids of tokens that begin with a space, and the line feed
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[number for token, number in vocabulary.items() if token[0] == self.space]] = True
        self.feed = vocabulary.get(self.letters[LINE_FEED])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _lowered(self, words: list[bytes], kind: int) -> Iterator[tuple]:
        letters, others, flat, lengths = [], [], [], []
        marks = {mark: [t.id for t in self.tokenize(mark)] for mark in ("", ".", ",")}
        for place, word in enumerate(words):
            if match := LATIN.fullmatch(text := word.decode("utf-8")):
                spelled = match[1].lower().encode("utf-8").decode("latin-1").translate(self.letters)
                ids = [token.id for token in self.tokenize(spelled)] + marks[match[2]]
                letters.append(place)
                flat += ids
                lengths.append(len(ids))
            elif not text[0].isspace():
                others.append(place)
        yield np.array(letters, dtype=np.int64), [(np.array(flat, dtype=np.uint32), np.array(lengths, dtype=np.int64))]
        for at in range(0, len(others), CALL_WORDS):
            some = others[at : at + CALL_WORDS]
            texts = [words[place].decode("utf-8") for place in some]
            ids = [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            runs = np.array([one for own in ids for one in own], dtype=np.uint32), np.array(list(map(len, ids)))
            yield np.array(some), [runs]

    def spaced(self, words: list[bytes], kind: int) -> Iterator[tuple]:
        """The ids of each word with the space or line feed before it."""
        letters, others, spelled = [], [], []
        for place, word in enumerate(words):
            text = word.decode("utf-8")
            if kind == BEHIND_SPACE and LATIN.fullmatch(text):
                letters.append(place)
                spelled.append(text if word.isascii() else word.decode("latin-1").translate(self.letters))
            elif not text[0].isspace():
                others.append(place)
        flat: list[int] = []
        for at in range(0, len(spelled), MODEL_WORDS):
            # no merge joins letters with a mark behind them, or crosses a space
            joined = self.space + self.space.join(spelled[at : at + MODEL_WORDS])
            flat += [token.id for token in self.tokenize(joined)]
        yield from self._parted(np.array(letters, dtype=np.int64), np.array(flat, dtype=np.uint32), kind)
        before = b"\n" if kind == BEHIND_FEED else b" "
        for at in range(0, len(others), CALL_WORDS):
            some = others[at : at + CALL_WORDS]
            text = (before + before.join([words[place] for place in some])).decode("utf-8")
            ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            yield from self._parted(np.array(some), np.array(ids, dtype=np.uint32), kind)

    def _parted(self, places: np.ndarray, ids: np.ndarray, kind: int) -> Iterator[tuple]:
        starts = np.flatnonzero(self.begins[ids] if kind == BEHIND_SPACE else ids == self.feed)
        # words whose ids can't be told apart have no entries, and texts with them are encoded whole
        if len(starts) == len(places):
            yield places, [(ids, np.diff(np.append(starts, len(ids))))]

    def encode(self, text: bytes) -> bytes:
        return self.encode_all(pa.array([text], pa.binary()))[0]

    def encode_all(self, column: pa.Array) -> list[bytes]:
        """Ids of each text of a column; null is empty."""
        data, offsets = text_bytes(column)
        odd = np.zeros(len(column), dtype=bool) if self.lowers else odd_texts(data, offsets)
        plain = np.flatnonzero(~odd)
        words = Words(*(text_bytes(column.take(pa.array(plain))) if odd.any() else (data, offsets)))
        skip = None
        if self.lowers:
            entries = self.table.entries(words)
        else:
            kinds = word_kinds(words)
            # a text's first word has nothing before it: its ids without those of a line feed
            skip = np.zeros(len(kinds), dtype=np.int64)
            skip[text_starts(words)] = kinds[text_starts(words)] = 1
            entries = self.table.entries(words, kinds)
        again = texts_with(words, entries < 0)
        ids, lengths = self.table.columns[0].take(np.maximum(entries, 0), skip) if len(entries) else (np.zeros(0, np.uint32), entries)
        packed = ids.astype("<u4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(lengths)])[words.bounds]).tolist()
        found: list = [None] * len(column)
        for place, a, b, whole in zip(plain.tolist(), cuts[:-1], cuts[1:], again.tolist()):
            if not whole:
                found[place] = packed[a:b]
        if None in found:
            texts = text_list(column)
            for place, ids in enumerate(found):
                if ids is None:
                    found[place] = self.whole(texts[place].decode("utf-8")).astype("<u4").tobytes()
        return found


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
