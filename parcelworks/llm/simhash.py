"""Near duplicates by SimHash fingerprints and the generalised pigeonhole principle.

A fingerprint has 64 bits, each the majority of that bit in the XXH64 hashes of a text's shingles of
three words. Two fingerprints link at ``DISTANCE`` differing bits or fewer. The bits are grouped
into partitions, correlated ones together. If the thresholds of the partitions add up to
``DISTANCE - partitions + 1``, fingerprints that link lie within the threshold in some partition;
a threshold of -1 leaves a partition out. Each fingerprint gets the thresholds that are cheapest
for it, by dynamic programming over the numbers of candidates to expect, so frequent values are
not probed where rarer ones will do. It then probes all values within its thresholds, and what
lies there is verified on all 64 bits.

Equal fingerprints are one row throughout. Counts of bits, of pairs of bits and of the values of
half partitions are all that comes to the driver: a number that does not depend on the table.
"""

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.groups import components, stored
from parcelworks.llm.scan import batch_of, slices, text_list

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
#: cost of a probe, in candidates verified
PROBE_COST = 4.0
#: numbers of partitions to choose from; halves of their bits are counted
PARTITIONS = (2, 3, 4, 5)
#: most fingerprints of a block, of which a task holds two
BLOCK = 32_768
#: buckets up to this size are compared all at once
SMALL = 64


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of words, repeats included; of all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - size].tolist(), ends[size - 1 :].tolist())]


def fingerprint(hashes: list[int]) -> int:
    """Bits set in more than half of the hashes."""
    values = np.array(hashes, dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), 65_536):
        part = values[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(values), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])
    for batch in batches:
        for part in slices(batch):
            prints = [_signed(fingerprint(shingle_hashes(text))) for text in text_list(part.column("text"))]
            yield batch_of(schema, doc_id=part.column("doc_id"), fingerprint=prints)


def bits_of(prints: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each fingerprint, the lowest bit first."""
    return np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _numbers(table: DataFrame, count: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all fingerprints of an array of ``size`` counts."""
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += count(batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64))
        places = np.flatnonzero(total)
        yield batch_of(schema, place=places, n=total[places])

    found = np.zeros(size, dtype=np.int64)
    summed = table.select("fingerprint").mapInArrow(rows, "place int, n long").groupBy("place").agg(F.expr("sum(n) AS n"))
    for row in summed.collect():
        found[row["place"]] = row["n"]
    return found


def _pairs_of_bits(prints: np.ndarray) -> np.ndarray:
    bits = bits_of(prints).astype(np.float32)
    return (bits.T @ bits).astype(np.int64).ravel()


def grouped_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` partitions of nearly equal widths, correlated ones together.

    ``together`` counts the fingerprints that have both bits of a pair. A partition starts with the
    bit that is most correlated with the bits left, and takes in the one most correlated with its
    own bits until it is full; ties go to the lower bit.
    """
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(share * (1 - share))
    norm = np.outer(spread, spread)
    covariance = np.abs(together / max(n, 1) - np.outer(share, share))
    strength = np.divide(covariance, norm, out=np.zeros_like(norm), where=norm > 0).round(9)
    np.fill_diagonal(strength, 0)
    left, found = list(range(BITS)), []
    for width in (BITS // parts + (place < BITS % parts) for place in range(parts)):
        group: list[int] = []
        for _ in range(width):
            against = group or left
            nearest = max(left, key=lambda bit: (strength[bit, against].sum(), -bit))
            group.append(nearest)
            left.remove(nearest)
        found.append(group)
    return found


def expected_cost(n: int, parts: int, distance: int = DISTANCE) -> float:
    """Cost of a fingerprint among ``n`` evenly spread ones, for the cheapest even thresholds."""
    from math import comb

    widths = [BITS // parts + (place < BITS % parts) for place in range(parts)]
    best = [0.0] + [float("inf")] * (distance + 1)
    for width in widths:
        costs = [0.0]
        for radius in range(distance + 1):
            ball = sum(comb(width, e) for e in range(radius + 1))
            costs.append(PROBE_COST * ball + n * ball / 2**width)
        best = [min(best[k - s] + costs[s] for s in range(k + 1)) for k in range(distance + 2)]
    return best[-1]


class Partitioning:
    """Partitions of the bits, and what the counts of their halves' values tell of candidates."""

    def __init__(self, groups: list[list[int]], distance: int = DISTANCE):
        self.distance = distance
        self.order = np.array([bit for group in groups for bit in group])
        self.widths = [len(group) for group in groups]
        #: first bit and width of each half partition, in the new order
        self.halves = []
        at = 0
        for width in self.widths:
            self.halves += [(at, width - width // 2), (at + width - width // 2, width // 2)]
            at += width
        self.sizes = [1 << width for _, width in self.halves]
        self.n, self.shells = 0, []

    def reordered(self, prints: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits_of(prints)[:, self.order], axis=1, bitorder="little")
        return np.ascontiguousarray(packed).view("<u8").ravel()

    @staticmethod
    def _cut(values: np.ndarray, at: int, width: int) -> np.ndarray:
        return ((values >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def half_counts(self, prints: np.ndarray) -> np.ndarray:
        values = self.reordered(prints)
        return np.concatenate(
            [np.bincount(self._cut(values, at, width), minlength=1 << width) for at, width in self.halves]
        )

    def learn(self, counts: np.ndarray, n: int) -> None:
        """For each half and value, how many fingerprints differ from it in 0, 1, 2, ... of its bits."""
        self.n, at = n, 0
        for (_, width), size in zip(self.halves, self.sizes):
            own = counts[at : at + size]
            at += size
            every = np.arange(size)
            shell = np.zeros((self.distance + 1, size), dtype=np.int64)
            for e in range(min(self.distance, width) + 1):
                for chosen in combinations(range(width), e):
                    shell[e] += own[every ^ sum(1 << bit for bit in chosen)]
            self.shells.append(shell)

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """The cheapest thresholds of each fingerprint, one row per partition; -1 leaves it out.

        With one more than each threshold, they add up to ``distance`` + 1. A partition costs its
        probes and the candidates to expect, its halves taken as independent.
        """
        budget = self.distance + 1
        best = np.full((budget + 1, len(values)), np.inf)
        best[0] = 0
        taken = []
        for part, width in enumerate(self.widths):
            (at, low), (at_high, high) = self.halves[2 * part : 2 * part + 2]
            one = self.shells[2 * part][:, self._cut(values, at, low)]
            two = self.shells[2 * part + 1][:, self._cut(values, at_high, high)]
            costs, candidates = [np.zeros(len(values))], 0
            for radius in range(budget):
                candidates = candidates + sum(one[e] * two[radius - e] for e in range(radius + 1)) / max(self.n, 1)
                costs.append(PROBE_COST * len(self.masks(width, radius)) + candidates)
            options = np.full((budget + 1, budget + 1, len(values)), np.inf)
            for total in range(budget + 1):
                for spent in range(total + 1):
                    options[total, spent] = best[total - spent] + costs[spent]
            taken.append(options.argmin(axis=1))
            best = options.min(axis=1)
        found = np.empty((len(self.widths), len(values)), dtype=np.int64)
        left, every = np.full(len(values), budget), np.arange(len(values))
        for part in range(len(self.widths) - 1, -1, -1):
            spent = taken[part][left, every]
            found[part] = spent - 1
            left = left - spent
        return found

    @staticmethod
    def masks(width: int, radius: int) -> np.ndarray:
        """All ways to flip at most ``radius`` of ``width`` bits, none first."""
        ways = [sum(1 << bit for bit in some) for e in range(radius + 1) for some in combinations(range(width), e)]
        return np.array(ways, dtype=np.int64)

    def places(self, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(rows, buckets, probing): each row's own bucket in every partition, and those it probes."""
        thresholds = self.thresholds(values)
        at = 0
        for part, width in enumerate(self.widths):
            own = self._cut(values, at, width)
            at += width
            for radius in range(-1, self.distance + 1):
                rows = np.flatnonzero(thresholds[part] == radius)
                if len(rows):
                    flips = self.masks(width, max(radius, 0))
                    buckets = (own[rows, None] ^ flips) + (part << 40)
                    yield np.repeat(rows, len(flips)), buckets.ravel(), radius >= 0


def partitioning(prints: DataFrame, distance: int = DISTANCE) -> Partitioning:
    """Partitions learnt from all distinct fingerprints."""
    together = _numbers(prints, _pairs_of_bits, BITS * BITS).reshape(BITS, BITS)
    n = prints.count()
    parts = min(PARTITIONS, key=lambda m: (expected_cost(n, m, distance), m))
    found = Partitioning(grouped_bits(together, n, parts), distance)
    found.learn(_numbers(prints, found.half_counts, sum(found.sizes)), n)
    return found


PLACED = pa.schema([("bucket", pa.int64()), ("fingerprint", pa.int64()), ("probes", pa.bool_())])


def _placed_rows(parts: Partitioning) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            for at, buckets, probing in parts.places(parts.reordered(given.view(np.uint64))):
                for first in range(0, len(at), 100_000):
                    prints = given[at[first : first + 100_000]]
                    yield batch_of(
                        PLACED,
                        bucket=buckets[first : first + 100_000],
                        fingerprint=prints,
                        probes=np.full(len(prints), probing),
                    )

    return rows


def _forest(ones: np.ndarray, twos: np.ndarray) -> tuple[list[int], list[int]]:
    """Those of the links that join what earlier ones had not joined."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, top)
        return top

    kept: tuple[list[int], list[int]] = ([], [])
    for a, b in zip(ones.tolist(), twos.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept[0].append(a)
            kept[1].append(b)
    return kept


def _tree(prints: np.ndarray, probes: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links that span each component of a bucket, by breadth-first search over what is not yet reached."""
    left = np.arange(len(prints))
    ones: list[int] = []
    twos: list[int] = []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            rows = front[: max(1, 1_000_000 // len(left))]
            front = front[len(rows) :]
            near = np.bitwise_count(prints[rows, None] ^ prints[left]) <= distance
            near &= probes[rows, None] | probes[left]
            reached = near.any(axis=0)
            if reached.any():
                ones += rows[near[:, reached].argmax(axis=0)].tolist()
                twos += left[reached].tolist()
                front = np.concatenate([front, left[reached]])
                left = left[~reached]
    return ones, twos


def linked(groups: np.ndarray, prints: np.ndarray, probes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (one, two) of links that span the components of each run of equal ``groups``."""
    edges = np.flatnonzero(np.diff(groups)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(groups)]])
    sizes = ends - starts
    ones: list[np.ndarray] = []
    twos: list[np.ndarray] = []
    last = np.repeat(ends, sizes)
    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL), sizes))
    step = 1
    while len(at := at[at + step < last[at]]):
        other = at + step
        near = np.bitwise_count(prints[at] ^ prints[other]) <= distance
        near &= probes[at] | probes[other]
        ones.append(at[near])
        twos.append(other[near])
        step += 1
    found = _forest(np.concatenate(ones), np.concatenate(twos)) if ones else ([], [])
    for group in np.flatnonzero(sizes > SMALL).tolist():
        a, b = int(starts[group]), int(ends[group])
        for kept, some in zip(found, _tree(prints[a:b], probes[a:b], distance)):
            kept += [a + place for place in some]
    return np.array(found[0], dtype=np.int64), np.array(found[1], dtype=np.int64)


def _link_rows(distance: int) -> Callable:
    """Links within buckets, which come one after another; a batch and one bucket more are held."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ("bucket", "low", "high", "fingerprint", "probes")

    def links(held: list[np.ndarray]) -> pa.RecordBatch:
        bucket, low, high, prints, probes = held
        new = np.zeros(len(bucket), dtype=np.int64)
        for values in (bucket, low, high):
            new[1:] |= values[1:] != values[:-1]
        ones, twos = linked(np.cumsum(new), prints.view(np.uint64), probes, distance)
        return batch_of(schema, a=prints[ones], b=prints[twos])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
            held = [np.concatenate(pair) for pair in zip(held, columns)] if held else columns
            open_row = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
            done = int(open_row.argmax())
            if done:
                yield links([column[:done] for column in held])
                held = [column[done:] for column in held]
        if held:
            yield links(held)

    return rows


def near_duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """Per document: key, fingerprint (16 hexadecimal digits), smallest key that links lead to.

    A null text, or one without words, has the fingerprint zero, which links like any other; a
    text of one or two words has one shingle of all of them. A document without a key has a
    fingerprint and a null component and links nothing. Rows with a repeated key each have their
    own fingerprint and its component. An empty table gives no row. Other columns are not read.
    """
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    marked = stored(narrow.mapInArrow(_fingerprint_rows, "doc_id long, fingerprint long"), "simhashes")
    named = marked.filter("doc_id IS NOT NULL")
    prints = stored(named.groupBy("fingerprint").agg(F.expr("min(doc_id) AS id")), "distinct-simhashes")
    parts = partitioning(prints, distance)
    placed = stored(
        prints.mapInArrow(_placed_rows(parts), "bucket long, fingerprint long, probes boolean"), "placed-simhashes"
    )
    # only buckets that something probes and that hold two rows can hold a link
    sizes = placed.groupBy("bucket").agg(F.expr("count(*) AS n"), F.expr("bool_or(probes) AS probed"))
    open_buckets = sizes.filter("n > 1 AND probed").selectExpr("bucket", f"int(ceil(n / {BLOCK})) AS blocks")
    # a block of a large bucket meets every other block once
    dealt = (
        placed.join(open_buckets, "bucket")
        .selectExpr("*", "int(pmod(xxhash64(fingerprint), blocks)) AS block")
        .selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr("bucket", "least(block, other) AS low", "greatest(block, other) AS high", "fingerprint", "probes")
        .repartition(F.col("bucket"), F.col("low"), F.col("high"))
        .sortWithinPartitions("bucket", "low", "high")
    )
    links = dealt.mapInArrow(_link_rows(distance), "a long, b long")
    groups = components(links).selectExpr("id AS fingerprint", "component AS class")
    classes = prints.join(groups, "fingerprint", "left").selectExpr(
        "fingerprint", "id", "coalesce(class, fingerprint) AS class"
    )
    least = classes.groupBy("class").agg(F.expr("min(id) AS component_id"))
    found = marked.join(classes.join(least, "class").select("fingerprint", "component_id"), "fingerprint", "left")
    return found.selectExpr(
        "doc_id", "lower(lpad(hex(fingerprint), 16, '0')) AS fingerprint",
        "CASE WHEN doc_id IS NOT NULL THEN component_id END AS component_id",
    )
