"""Plain versions of the operators' results, one document after another, to hold them against."""

import hashlib
import re
import zlib
from base64 import b32encode
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles_of(text: str | None) -> set[tuple[str, ...]]:
    words = words_of(lowered(text))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def edited_digests(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, str]]:
    """Number of characters and digest of the edited text, by key."""
    ordered = sorted(docs, reverse=True)
    out = {}
    for place, (key, text) in enumerate(ordered):
        text, following = text or "", ordered[(place + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        out[key] = (len(text), sha256(text[: len(text) - cut] + following[:cut]))
    return out


def repeats_removed(docs: list[tuple[int, str | None]], window: int = 13) -> dict[int, tuple[int, int, str]]:
    least: dict[tuple[str, ...], int] = {}
    for key, text in sorted(docs):
        words = words_of(text)
        for i in range(len(words) - window + 1):
            least.setdefault(tuple(words[i : i + window]), key)
    out = {}
    for key, text in docs:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if least[tuple(words[i : i + window])] < key:
                gone.update(range(i, i + window))
        kept = [word for i, word in enumerate(words) if i not in gone]
        out[key] = (len(words), len(gone), sha256(" ".join(kept)))
    return out


def near_groups(docs: list[tuple[int, str | None]], percent: int = 75) -> dict[int, tuple[int, int, bool]]:
    sets = {key: shingles_of(text) for key, text in docs}
    holders = defaultdict(set)
    for key, some in sets.items():
        for one in some:
            holders[one].add(key)
    parent = {key: key for key in sets}

    def root(key: int) -> int:
        while parent[key] != key:
            key = parent[key]
        return key

    for key, some in sets.items():
        shared: dict[int, int] = defaultdict(int)
        for one in some:
            for other in holders[one]:
                if other > key:
                    shared[other] += 1
        for other, common in shared.items():
            if 100 * common >= percent * (len(some) + len(sets[other]) - common):
                a, b = root(key), root(other)
                parent[max(a, b)] = min(a, b)
    return {key: (len(some), root(key), root(key) == key) for key, some in sets.items()}


def lines_deduped(docs: list[tuple[int, str | None]], window: int = 3) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for key, text in sorted(docs):
        lines = text.split("\n") if text else []
        gone = set()
        for i in range(len(lines) - window + 1):
            some = tuple(lines[i : i + window])
            if some in seen:
                gone.update(range(i, i + window))
            seen.add(some)
        out[key] = (len(lines), len(gone), "\n".join(line for i, line in enumerate(lines) if i not in gone))
    return out


def archived(pages: list[tuple[int, str | None]], least_bytes: int = 0) -> dict[int, tuple[int, str, str, int | None]]:
    first: dict[bytes, int] = {}
    for key, html in sorted(pages):
        first.setdefault((html or "").encode("utf-8"), key)
    out = {}
    for key, html in pages:
        data = (html or "").encode("utf-8")
        again = len(data) >= least_bytes and first[data] != key
        digest = b32encode(hashlib.sha1(data).digest()).decode()
        out[key] = (len(data), digest, "revisit" if again else "response", first[data] if again else None)
    return out


def crc_of_ids(ids: list[int]) -> int:
    return zlib.crc32(b"".join(one.to_bytes(4, "little") for one in ids))


def components_of(keys, links):
    """The smallest key that each key reaches over the links."""
    parent = {key: key for key in keys}

    def root(key):
        while parent[key] != key:
            parent[key] = parent[parent[key]]
            key = parent[key]
        return key

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {key: root(key) for key in parent}


def simhash(text: str | None) -> int:
    import xxhash

    words = words_of(lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(one.encode("utf-8"), 42) for one in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def simhash_groups(docs: list[tuple[int, str | None]], distance: int = 3) -> dict[int, tuple[str, int]]:
    prints = {key: simhash(text) for key, text in docs}
    keys = sorted(prints)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= distance]
    found = components_of(keys, links)
    return {key: (f"{prints[key]:016x}", found[key]) for key in keys}


def alignment(docs: list[tuple[int, str | None]], byte_path: str, piece_path: str) -> list[tuple]:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each document, in order."""
    from itertools import accumulate

    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(byte_path)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(byte): byte for byte in plain}
    letters |= {chr(256 + n): byte for n, byte in enumerate(b for b in range(256) if b not in plain)}

    def piece(number: int) -> bytes:
        text = two.id_to_piece(number)
        return bytes([int(text[3:5], 16)]) if two.is_byte(number) else text.replace("▁", " ").encode("utf-8")

    def groups(text: str | None) -> list[tuple[list[int], list[int]]]:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = two.encode(text or "")
        spelled_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
        spelled_b = [piece(i) for i in b]
        if not text or not b"".join(spelled_a) == b"".join(spelled_b) == (" " + text).encode("utf-8"):
            return []
        ends_a, ends_b = (list(accumulate(map(len, some))) for some in (spelled_a, spelled_b))
        cuts = sorted(set(ends_a) & set(ends_b))
        return [
            ([i for i, e in zip(a, ends_a) if low < e <= high], [i for i, e in zip(b, ends_b) if low < e <= high])
            for low, high in zip([0, *cuts], cuts)
        ]

    of_docs = [(key, groups(text)) for key, text in docs]
    counts: dict[tuple[int, int], int] = defaultdict(int)
    for _, some in of_docs:
        for pair in {(x, y) for p, q in some for x in p for y in q}:
            counts[pair] += 1
    best: dict[int, int] = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for key, some in of_docs:
        links = [(x, y) for p, q in some for x in p for y in q]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in some)
        out.append(
            (key, sum(len(p) for p, _ in some), sum(len(q) for _, q in some), len(some), len(links),
             sum(counts[link] == best[link[0]] for link in links), sum(counts[link] for link in links),
             sha256(text) if some else "")
        )
    return out


def hard_negatives(rows: list[tuple[int, list[float], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive score, negative score) over (key, vector, label)."""
    import math

    usable = [
        (key, [math.floor(256 * x) for x in vector], label)
        for key, vector, label in rows
        if None not in (key, vector, label) and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for key, vector, label in usable:
        if key % 100:
            continue
        scored = sorted((max(-(2**63 - 1), min(2**63, -sum(x * y for x, y in zip(vector, other)))), k, own) for k, other, own in usable)
        for minus, positive, _ in [one for one in scored if one[2] == label and one[1] != key][:5]:
            inside = [one for one in scored if one[2] != label and 30 * -minus <= 100 * -one[0] <= 90 * -minus][:10]
            out += [(key, positive, rank, k, -minus, -score) for rank, (score, k, _) in enumerate(inside, 1)]
    return out
