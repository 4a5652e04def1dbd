"""Personal data in whole texts: fixed patterns, and a linear-chain conditional random field.

The patterns give the base spans. The field adds spans that no pattern describes: secrets such as
keys and tokens, and addresses and numbers written in other ways. Its states are the kinds and
"other"; its features are the shapes of a word and of its two neighbours on either side and a few
cue words, so a word has one row of weights per neighbour and nothing depends on rare words. It is
trained on a small labelled table by gradient ascent on the penalised likelihood (forward-backward
on padded sentences), and decoded by Viterbi over many sequences of words at a time.

Every word of a text is decoded, as one sequence. Where a word's scores favour "other" by more
than any transitions could make good, the best path surely goes through "other" there; such words
part a text into short sequences, with the same states as the whole text's. A found span must pass
the checks of its kind, and must not meet a base span.
"""

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.scan import Words, batch_of, slices, text_bytes

KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = (*KINDS, "secret")
STATES = ("other", *ADDED_KINDS)

# fixed patterns of the base spans
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# the same, said so that no run of digits or letters is gone through from each of its places
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
WHOLE_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def passes(kind: str, text: str) -> bool:
    """Whether a match of a kind is one."""
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))
    if kind == "card":
        digits = digits_of(text)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits_of(text)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, in one go: each sign has its own run of letters before it.

    A match that does not begin at the first letter of that run, or right behind the last match,
    would go on from the same sign, so it fails where that one fails.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each kind that pass its checks, by kind and start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for kind, pattern in (("ip", WHOLE_IP), ("card", CARD), ("phone", PHONE)):
        if kind == "phone" and "+" not in text or kind == "ip" and "." not in text:
            continue
        for match in pattern.finditer(text):
            if passes(kind, match[0]):
                found.append((kind, *match.span()))
    return found


# --- shapes -------------------------------------------------------------------------------------

CUES = ("token", "key", "secret", "password", "api_key", "phone", "tel", "call", "card", "mail", "email", "ip", "=", ":", "at", "dot")
_PLAIN = re.compile(r"[^\W\d_]+[.,;:!?]*")


def shape(word: str) -> str:
    """A word's shape: cue words as they are, else runs of letters and digits with their lengths."""
    return _known_shape(word) if len(word) <= 64 else _shape(word)


@lru_cache(maxsize=100_000)
def _known_shape(word: str) -> str:
    return _shape(word)


def _shape(word: str) -> str:
    bare = word.strip("\"'()[]{}<>,;").rstrip(".:!?").lower()
    if bare in CUES:
        return f"cue {bare}"
    if word in ("=", ":", "=>", ":="):
        return "cue ="
    if re.fullmatch(r"[0-9a-f]+", bare) and len(bare) >= 16 and re.search("[0-9]", bare) and re.search("[a-f]", bare):
        return "long hex"
    if _PLAIN.fullmatch(word):
        return "plain"
    if len(bare) >= 20 and re.fullmatch(r"[\w+/=-]+", bare) and len(re.findall(r"[0-9]", bare)) >= 4 and re.search(r"[a-z]", bare):
        return "long mixed"
    runs = []
    for run in re.finditer(r"[0-9]+|[^\W\d_]+|.", bare):
        text = run[0]
        if text.isdigit():
            size = len(text)
            runs.append("9" * size if size <= 4 else f"9<{next((n for n in (8, 12, 19, 40) if size <= n), 'more')}>")
        elif text.isalpha():
            runs.append("a")
        else:
            runs.append(text)
    if not any(run[0] == "9" for run in runs) and "@" not in runs:
        return "marks"
    return "".join(runs)


# --- the small labelled table -------------------------------------------------------------------


def labelled_rows(sentences: int = 400, seed: int = 11) -> list[tuple[int, list[str], list[str]]]:
    """(sentence, words, states) from a rule: invented prose with invented personal data put in."""
    random = np.random.Generator(np.random.PCG64(seed))
    pick = lambda values: values[int(random.integers(len(values)))]
    digits = lambda n: "".join(str(int(d)) for d in random.integers(0, 10, n))
    hexes = lambda n: "".join("0123456789abcdef"[int(d)] for d in random.integers(0, 16, n))
    word = lambda: "".join(pick(["an", "er", "on", "the", "ti", "es", "ou", "re", "in"]) for _ in range(1 + int(random.integers(4))))

    def filler() -> list[str]:
        words = [word() for _ in range(1 + int(random.integers(6)))]
        words[-1] += pick(["", "", ",", "."])
        return words

    def item() -> tuple[list[str], str]:
        kind = pick(["email", "ip", "card", "phone", "secret", "secret", "number", "number", "marks"])
        if kind == "email":
            return pick([[f"{word()}.{digits(2)}@{word()}.example.com"], [f"{word()}@{word()}.org"], [word(), "at", word(), "dot", "com"]]), kind
        if kind == "ip":
            return [".".join(str(int(n)) for n in random.integers(0, 256, 4))], kind
        if kind == "card":
            return pick([[digits(16)], [digits(4) for _ in range(4)], ["-".join(digits(4) for _ in range(4))], [".".join(digits(4) for _ in range(4))]]), kind
        if kind == "phone":
            area, line = digits(3), f"{digits(3)}-{digits(4)}"
            return pick([["+1", f"({area})", line], [f"({area})", line], [f"{area}-{line}"], [f"+{digits(2)}", digits(3), digits(6)]]), kind
        if kind == "secret":
            value = pick([hexes(40), hexes(32), hexes(64)])
            name = pick(["token", "key", "secret", "password", "api_key"])
            return pick([[name, "=", f'"{value}"'], [f"{name}:", value], [value]]), kind
        if kind == "number":
            return pick([[digits(2)], [digits(4)], [f"{digits(2)}.{digits(2)}"], [f"{digits(1)},{digits(3)}"], [f"{digits(2)}:{digits(2)}"], [f"{digits(4)}-{digits(2)}-{digits(2)}"], [digits(6)], [f"{digits(2)}%"], [f"v{digits(1)}.{digits(1)}"]]), "other"
        return pick([[f"{word()}###", f"{word()}$$$"], [word(), "|", word(), "|"], [f"{word().upper()}!!"], ["=", word()], ["token", word()]]), "other"

    rows = []
    for number in range(sentences):
        words, states = [], []
        for _ in range(1 + int(random.integers(3))):
            before = filler()
            some, kind = item()
            words += before + some
            states += ["other"] * len(before) + [kind] * len(some)
        after = filler()
        words, states = words + after, states + ["other"] * len(after)
        # the names of secrets are no secrets
        states = [
            "other" if state == "secret" and (shape(w).startswith("cue") or w == "=") else state
            for w, state in zip(words, states)
        ]
        rows.append((number, words, states))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "sentence int, words array<string>, states array<string>")


# --- the field ----------------------------------------------------------------------------------

REACH = 2


@dataclass(frozen=True)
class Field:
    """Weights: per place from two words before to two after a row per shape; and of state pairs."""

    shapes: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray
    begin: np.ndarray

    def ids(self, words: list[str]) -> list[int]:
        return [self.shapes.get(shape(word), 1) for word in words]

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(sequences, words, states) for padded shape numbers; 0 stands outside a sequence."""
        padded = np.pad(ids, ((0, 0), (REACH, REACH)))
        return sum(self.emission[k][padded[:, k : k + ids.shape[1]]] for k in range(2 * REACH + 1))

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The likeliest states of padded sequences of shape numbers, longest first."""
        scores = self.emissions(ids)
        scores[:, 0] += self.begin
        return self.paths(scores, sizes)

    def paths(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best paths by Viterbi over padded sequences of scores, longest first."""
        count, length, states = scores.shape
        back = np.zeros((length, count, states), dtype=np.int8)
        best = scores[:, 0]
        final = np.zeros((count, states))
        open_ = np.searchsorted(-sizes, -np.arange(1, length + 1), "right")
        for place in range(1, length):
            some = int(open_[place])
            final[some : int(open_[place - 1])] = best[some : int(open_[place - 1])]
            ways = best[:some, :, None] + self.transition
            back[place, :some] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[:some, place]
        final[: len(best)] = best
        found = np.zeros((count, length), dtype=np.int8)
        state = final.argmax(axis=1)
        rows = np.arange(count)
        for place in range(length - 1, -1, -1):
            inside = place < sizes
            found[inside, place] = state[inside]
            if place:
                state = np.where(inside, back[place, rows, state], state)
        return found

    def surely_other(self, scores: np.ndarray) -> np.ndarray:
        """Which words are "other" on the best path whatever stands before and behind them."""
        into = np.maximum((self.transition - self.transition[:, :1]).max(axis=0), self.begin - self.begin[0])
        onward = np.maximum((self.transition - self.transition[0]).max(axis=1), 0)
        return (scores[:, :1] - scores[:, 1:] > (into + onward)[1:]).all(axis=1)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def fit(rows: list[tuple[int, list[str], list[str]]], rounds: int = 80, penalty: float = 0.02, rate: float = 0.15) -> Field:
    """The field of a labelled table, by full-gradient steps of the Adam method.

    Shapes that no sentence has share one row. A table without sentences gives a field that finds
    nothing. The table must be small: all of it is in the driver's memory.
    """
    names = sorted({shape(word) for _, words, _ in rows for word in words})
    shapes = {name: place + 2 for place, name in enumerate(names)}
    states = len(STATES)
    field = Field(shapes, np.zeros((2 * REACH + 1, len(names) + 2, states)), np.zeros((states, states)), np.zeros(states))
    rows = [row for row in rows if row[1]]
    if not rows:
        field.emission[:, :, 0] = 1.0
        return field
    sizes = np.array([len(words) for _, words, _ in rows])
    length = int(sizes.max())
    ids, gold = np.zeros((len(rows), length), dtype=np.int64), np.zeros((len(rows), length), dtype=np.int64)
    for number, (_, words, marks) in enumerate(rows):
        ids[number, : len(words)] = field.ids(words)
        gold[number, : len(words)] = [STATES.index(mark) for mark in marks]
    inside = np.arange(length) < sizes[:, None]
    onehot = np.eye(states)[gold] * inside[:, :, None]
    weights = [field.emission, field.transition, field.begin]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        scores = field.emissions(ids)
        ahead = np.zeros_like(scores)
        ahead[:, 0] = field.begin + scores[:, 0]
        for t in range(1, length):
            moved = _log_sum(ahead[:, t - 1, :, None] + field.transition, 1) + scores[:, t]
            ahead[:, t] = np.where(inside[:, t, None], moved, ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        behind = np.zeros_like(scores)
        pair_gap = np.zeros_like(field.transition)
        for t in range(length - 2, -1, -1):
            onward = scores[:, t + 1] + behind[:, t + 1]
            moved = _log_sum(field.transition + onward[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], moved, 0.0)
            pairs = np.exp(ahead[:, t, :, None] + field.transition + onward[:, None, :] - total[:, None, None])
            real = inside[:, t + 1, None, None]
            pair_gap += (real * (onehot[:, t, :, None] * onehot[:, t + 1, None, :] - pairs)).sum(axis=0)
        gap = (onehot - np.exp(ahead + behind - total[:, None, None])) * inside[:, :, None]
        emission_gap = np.zeros_like(field.emission)
        padded = np.pad(ids, ((0, 0), (REACH, REACH)))
        for k in range(2 * REACH + 1):
            np.add.at(emission_gap[k], padded[:, k : k + length], gap)
        for number, (weight, slope) in enumerate(zip(weights, (emission_gap, pair_gap, gap[:, 0].sum(axis=0)))):
            slope = slope / len(rows) - penalty / len(rows) * weight
            first[number] = 0.9 * first[number] + 0.1 * slope
            second[number] = 0.99 * second[number] + 0.01 * slope**2
            weight += rate * (first[number] / (1 - 0.9**step)) / (np.sqrt(second[number] / (1 - 0.99**step)) + 1e-8)
    # a shape never seen says nothing by itself
    field.emission[:, 1] = 0.0
    return field


# --- spans of whole texts -----------------------------------------------------------------------

KEPT_WORDS = 50_000
KEPT_BYTES = 40
BATCH_WORDS = 200_000


class ShapeNumbers(dict):
    """Shape numbers of words given as bytes; a bounded number of short words is kept."""

    def __init__(self, field: Field):
        self.field = field

    def __missing__(self, word: bytes) -> int:
        found = self.field.ids([word.decode("utf-8", "replace")])[0]
        if len(word) <= KEPT_BYTES:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found


def _scores(field: Field, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(words, states) of a slice's texts one after another; 0 stands outside a text."""
    places = np.arange(len(ids)) + REACH * np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    padded = np.zeros(len(ids) + REACH * len(bounds), dtype=np.int64)
    padded[places + REACH] = ids
    return sum(field.emission[k][padded[places + k]] for k in range(2 * REACH + 1))


def states_of(field: Field, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The likeliest states of all words of texts, given their shape numbers; text i has those from bounds[i] on."""
    states = np.zeros(len(ids), dtype=np.int8)
    scores = _scores(field, ids, bounds)
    undecided = np.flatnonzero(~field.surely_other(scores))
    if not len(undecided):
        return states
    text = np.searchsorted(bounds, undecided, "right") - 1
    apart = np.append(True, (np.diff(undecided) > 1) | (np.diff(text) > 0))
    begin, text = undecided[apart], text[apart]
    end = undecided[np.append(np.flatnonzero(apart)[1:] - 1, len(undecided) - 1)] + 1
    # a sequence begins its text or follows an "other", and ends its text or precedes one
    scores[begin] += np.where((begin == bounds[text])[:, None], field.begin, field.transition[0])
    scores[end - 1] += np.where((end == bounds[text + 1])[:, None], 0.0, field.transition[:, 0])
    sizes = end - begin
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        width = int(sizes[order[at]])
        some = order[at : at + max(1, BATCH_WORDS // width)]
        inside = np.arange(width) < sizes[some][:, None]
        places = (begin[some][:, None] + np.arange(width))[inside]
        padded = np.zeros((len(some), width, len(STATES)))
        padded[inside] = scores[places]
        states[places] = field.paths(padded, sizes[some])[inside]
        at += len(some)
    return states


def added_spans(
    field: Field, data: np.ndarray, offsets: np.ndarray, numbers: ShapeNumbers | None = None
) -> dict[int, list[tuple[str, int, int]]]:
    """Per text the field's spans (kind, first byte, byte behind) in the slice."""
    numbers = ShapeNumbers(field) if numbers is None else numbers
    words = Words(data, offsets, hashes=False)
    raw, edges = data.tobytes(), offsets.tolist()
    spelled = (word for a, b in zip(edges, edges[1:]) for word in raw[a:b].split())
    ids = np.fromiter(map(numbers.__getitem__, spelled), dtype=np.int64, count=len(words.starts))
    states = states_of(field, ids, words.bounds)
    found: dict[int, list[tuple[str, int, int]]] = {}
    hits = np.flatnonzero(states)
    if not len(hits):
        return found
    owner = np.searchsorted(words.bounds, hits, "right") - 1
    joined = (np.diff(hits) == 1) & (np.diff(states[hits]) == 0) & (np.diff(owner) == 0)
    firsts = np.flatnonzero(np.append(True, ~joined))
    lasts = np.append(firsts[1:] - 1, len(hits) - 1)
    for text, a, b in zip(owner[firsts].tolist(), hits[firsts].tolist(), hits[lasts].tolist()):
        found.setdefault(text, []).append((STATES[states[a]], int(words.starts[a]), int(words.ends[b])))
    return found


TRIM = "\"'`()[]{}<>,;.:!?|"


def _trimmed(kind: str, text: str) -> tuple[int, int]:
    strip = TRIM.replace("(", "").replace(")", "") if kind == "phone" else TRIM
    left = len(text) - len(text.lstrip(strip))
    return left, len(text.rstrip(strip))


def acceptable(kind: str, text: str) -> bool:
    """The checks of an added span: those of its kind, and a secret is long and mixed."""
    if kind == "secret":
        return len(text) >= 16 and not re.search(r"\s", text) and bool(re.search("[0-9]", text)) and bool(re.search("[A-Za-z]", text))
    if kind == "email":
        return bool(re.fullmatch(r"\S+(@|\s+at\s+)\S+(\.|\s+dot\s+)\S+", text))
    if kind == "ip":
        return bool(IP.fullmatch(text)) and passes(kind, text)
    return passes(kind, text)


RESULT = pa.schema(
    [("doc_id", pa.int64()), *[(f"n_{kind}", pa.int64()) for kind in KINDS], ("n_spans", pa.int64()), ("base", pa.string()), ("spans", pa.string())]
)


def _joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda span: (ADDED_KINDS.index(span[0]), span[1], span[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


def _united(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Begins and ends of the places that spans cover, disjoint and ascending."""
    begins, ends = [], []
    for _, a, b in sorted(spans, key=lambda span: span[1:]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    return begins, ends


def _is_free(taken: tuple[list[int], list[int]], begin: int, end: int) -> bool:
    """Whether no taken place lies between."""
    at = bisect_right(taken[1], begin)
    return at == len(taken[0]) or taken[0][at] >= end


def _span_rows(field: Field) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = ShapeNumbers(field)
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                added = added_spans(field, data, offsets, numbers)
                raw = data.tobytes()
                out = []
                for number, (key, text) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())):
                    base = base_spans(text or "")
                    spans = list(base)
                    taken = _united(base)
                    at, place = int(offsets[number]), 0
                    for kind, a, b in sorted(added.get(number, ()), key=lambda span: span[1:]):
                        # code points up to the span, counted on from the span before
                        place += len(raw[at:a].decode("utf-8", "replace"))
                        at = a
                        piece = raw[a:b].decode("utf-8", "replace")
                        left, right = _trimmed(kind, piece)
                        begin, end = place + left, place + right
                        if left < right and acceptable(kind, piece[left:right]) and _is_free(taken, begin, end):
                            spans.append((kind, begin, end))
                    counts = [sum(kind == one[0] for one in base) for kind in KINDS]
                    out.append((key, *counts, len(spans), _joined(base), _joined(spans)))
                yield batch_of(RESULT, **dict(zip(RESULT.names, zip(*out))))

    return rows


def find_personal_data(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, numbers of base spans of each kind and of all spans, the base spans and all as text.

    A span is ``kind:start:end`` in code points, end exclusive; spans are ordered by kind, then
    start, and joined by commas. ``labelled`` is the small table to train on, with columns words
    and states. Null and empty texts have no spans; rows without a key, repeated rows and columns
    of any other name do no harm. An empty table gives no row.
    """
    rows = [(n, row["words"], row["states"]) for n, row in enumerate(labelled.select("words", "states").collect())]
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_spans long, base string, spans string"
    return narrow.mapInArrow(_span_rows(fit(rows)), schema)


def base_digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
