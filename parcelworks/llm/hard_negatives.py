"""Hard negatives of anchors, found by bounds along a spanning tree of the anchors.

A vector is whole numbers: each component times 256, rounded down. Rows score by their inner product
with an anchor. Anchors come in blocks of about ``BLOCK_ANCHORS``, each with its minimum spanning
tree. Where a parent anchor's score with a candidate is known to lie between two bounds, the
child's lies between them less and plus the length of the edge times the candidate's norm. The
root is scored with all candidates; going down the tree, a child is scored only with candidates
whose bounds overlap a window that still takes part, and the others pass their wider bounds on.

Two passes use this. The first keeps each anchor's best rows of its label, the window being all
above the last one kept so far. The second keeps, for each positive, the best rows of other labels
within its range, the window's lower end rising likewise. Blocks of candidates meet blocks of
anchors by a join on the block's number, and a few rows per anchor and task are what is shuffled.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.groups import stored
from parcelworks.llm.ordering import partitions
from parcelworks.llm.scan import batch_of

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
BLOCK_ANCHORS = 256
BLOCK_CANDIDATES = 2048
#: whole numbers below this are exact as doubles
EXACT = 2**53
#: packed candidates of a task
TASK_BYTES = 16_000_000
LONG = 2**63 - 1

CANDIDATES_SQL = "ids binary, labels binary, vectors binary, width int"
CANDIDATES = pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("width", pa.int32())])


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled up with zeros."""
    found = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for row, vector in enumerate(vectors):
        found[row, : len(vector)] = vector
    return found


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    kind = "<i2" if len(row["vectors"]) == 2 * len(ids) * row["width"] else "<f8"
    return ids, labels, np.frombuffer(row["vectors"], kind).reshape(len(ids), row["width"]).astype(np.float64)


def _packed_row(schema: pa.Schema, ids, labels, vectors: list[np.ndarray], **more) -> pa.RecordBatch:
    matrix = _matrix(vectors)
    kind = "<i2" if np.abs(matrix).max(initial=0) < 2**15 else "<f8"
    return batch_of(
        schema,
        ids=[np.array(ids, dtype="<i8").tobytes()],
        labels=[np.array(labels, dtype="<i8").tobytes()],
        vectors=[matrix.astype(kind).tobytes()],
        width=[matrix.shape[1]],
        **{name: [value] for name, value in more.items()},
    )


def _whole(vector: list[float]) -> np.ndarray:
    return np.floor(np.array(vector, dtype=np.float64) * SCALE)


def _candidate_rows(size: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.slice(at, size).to_pydict()
                yield _packed_row(CANDIDATES, part["id"], part["label"], list(map(_whole, part["vector"])))

    return rows


ANCHORS_SQL = "block int, " + CANDIDATES_SQL
ANCHORS = pa.schema([("block", pa.int32()), *CANDIDATES])


def _anchor_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of a partition as one block with the partition's number."""
    from pyspark import TaskContext

    columns: dict[str, list] = {"id": [], "label": [], "vector": []}
    for batch in batches:
        for name, values in columns.items():
            values += batch.column(name).to_pylist()
    if columns["id"]:
        number = TaskContext.get().partitionId()
        yield _packed_row(ANCHORS, columns["id"], columns["label"], list(map(_whole, columns["vector"])), block=number)


class Tree:
    """A minimum spanning tree over the rows of a matrix, by Prim's method from the first row."""

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        parent, edge, depth = np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n, dtype=np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            nearest = self._distances(vectors, 0)
            outside = np.ones(n, dtype=bool)
            outside[0] = False
            for _ in range(n - 1):
                new = int(np.where(outside, nearest, np.inf).argmin())
                if not outside[new]:
                    new = int(outside.argmax())
                outside[new] = False
                edge[new], depth[new] = nearest[new], depth[parent[new]] + 1
                away = self._distances(vectors, new)
                closer = outside & (away < nearest)
                nearest[closer], parent[closer] = away[closer], new
        self.parent = parent
        #: lengths are rounded up, so that bounds hold
        self.edge = np.nextafter(edge * (1 + 1e-9), np.inf)
        self.levels = [np.flatnonzero(depth == level) for level in range(int(depth.max(initial=0)) + 1)]

    @staticmethod
    def _distances(vectors: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(((vectors - vectors[row]) ** 2).sum(axis=1))


def _product(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: in doubles where they hold them, else in Python's whole numbers."""
    width = min(one.shape[1], two.shape[1])
    one, two = one[:, :width], two[:, :width]
    if width * np.abs(one).max(initial=0) * np.abs(two).max(initial=0) < EXACT:
        return one @ two.T
    whole = lambda matrix: np.array([[int(x) for x in row] for row in matrix], dtype=object).reshape(matrix.shape)
    return whole(one).dot(whole(two).T)


def _within_long(score: int) -> int:
    return max(-LONG - 1, min(LONG, score))


class Block:
    """A block of anchors on its way through candidates."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ids, self.labels, self.vectors = _unpacked(row)
        self.tree = Tree(self.vectors)
        #: pairs of an anchor and a candidate seen, and scored
        self.seen = self.scored = 0

    def scores(self, vectors: np.ndarray, wanted: Callable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per level of the tree (anchors, exact, which): scores, and of which pairs they were computed.

        ``wanted(anchors, low, high)`` tells the pairs whose bounds overlap a window.
        """
        norms = np.sqrt((vectors**2).sum(axis=1)) * (1 + 1e-9)
        low, high = np.empty((len(self.ids), len(vectors))), np.empty((len(self.ids), len(vectors)))
        self.seen += low.size
        for level, anchors in enumerate(self.tree.levels):
            if level:
                above = self.tree.parent[anchors]
                reach = self.tree.edge[anchors, None] * norms
                slack = 1e-9 * (np.abs(low[above]) + np.abs(high[above]) + reach) + 1
                low[anchors], high[anchors] = low[above] - reach - slack, high[above] + reach + slack
                which = wanted(anchors, low[anchors], high[anchors])
            else:
                which = np.ones((1, len(vectors)), dtype=bool)
            columns = np.flatnonzero(which.any(axis=0))
            if not len(columns):
                continue
            exact = np.zeros(which.shape, dtype=object)
            found = _product(self.vectors[anchors], vectors[columns])
            if found.dtype != object:
                exact = np.zeros(which.shape)
            exact[:, columns] = found
            self.scored += int(which.sum())
            known = exact.astype(np.float64)
            if found.dtype == object:
                exact = np.vectorize(_within_long, otypes=[object])(exact)
            low[anchors] = np.where(which, known - np.abs(known) * 1e-15, low[anchors])
            high[anchors] = np.where(which, known + np.abs(known) * 1e-15, high[anchors])
            yield anchors, exact, which


def _first(scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` rows: by score, the highest first, then by id and label."""
    if len(scores) > 8 * count and scores.dtype != object:
        # all with at least the score of the last one wanted
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((labels[some], ids[some], -scores[some]))[:count]]
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i], labels[i]))
    return np.array(order[:count], dtype=np.int64)


class _Best:
    """The first rows of one ranking so far, and the score that a new row needs."""

    def __init__(self, count: int):
        self.count, self.rows, self.least = count, [], -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        chosen = _first(scores, ids, labels, self.count)
        new = [(int(scores[i]), int(ids[i]), int(labels[i])) for i in chosen.tolist()]
        self.rows = sorted([*self.rows, *new], key=lambda row: (-row[0], *row[1:]))[: self.count]
        if len(self.rows) == self.count:
            self.least = float(self.rows[-1][0])
            if abs(self.least) >= EXACT:
                self.least = float(np.nextafter(self.least, -np.inf))


FOUND_SQL = "block int, place int, which int, anchor_id long, score long, id long, label long"
FOUND = pa.schema(
    [("block", pa.int32()), ("place", pa.int32()), ("which", pa.int32())]
    + [(name, pa.int64()) for name in ("anchor_id", "score", "id", "label")]
)


def _mined_rows(positives: int, negatives: int) -> Callable:
    """The first rows of every ranking of the anchors' blocks, one row of candidates after another."""

    def flushed(block: Block, rankings: dict) -> Iterator[pa.RecordBatch]:
        rows = [
            (block.number, place, which, int(block.ids[place]), score, id, label)
            for (place, which), best in rankings.items()
            for score, id, label in best.rows
        ]
        if rows:
            yield batch_of(FOUND, **dict(zip(FOUND.names, zip(*rows))))

    def same_label(block: Block, rankings: dict, ids, labels, vectors) -> None:
        def wanted(anchors, low, high):
            least = np.array([rankings[place, 0].least for place in anchors.tolist()])[:, None]
            return (labels == block.labels[anchors, None]) & (ids != block.ids[anchors, None]) & (high >= least)

        for anchors, exact, which in block.scores(vectors, wanted):
            which = which & (labels == block.labels[anchors, None]) & (ids != block.ids[anchors, None])
            for row, place in enumerate(anchors.tolist()):
                if len(some := np.flatnonzero(which[row])):
                    rankings[place, 0].add(exact[row, some], ids[some], labels[some])

    def other_label(block: Block, rankings: dict, ids, labels, vectors) -> None:
        def wanted(anchors, low, high):
            found = np.zeros(low.shape, dtype=bool)
            for which in range(positives):
                score = block.positive[anchors, which, None]
                least = np.array([rankings[place, which].least for place in anchors.tolist()])[:, None]
                window = (100 * high >= LEAST_PERCENT * score) & (100 * low <= MOST_PERCENT * score)
                found |= window & (high >= least) & block.has[anchors, which, None]
            return found & (labels != block.labels[anchors, None])

        for anchors, exact, some in block.scores(vectors, wanted):
            some = some & (labels != block.labels[anchors, None])
            for row, place in enumerate(anchors.tolist()):
                candidates = np.flatnonzero(some[row])
                scores = exact[row, candidates]
                for which in range(positives):
                    if not block.has[place, which]:
                        continue
                    score = block.whole[place][which]
                    if scores.dtype != object and 100 * max(abs(score), np.abs(scores).max(initial=0)) >= EXACT:
                        scores = np.array([int(x) for x in scores], dtype=object)
                    window = (100 * scores >= LEAST_PERCENT * score) & (100 * scores <= MOST_PERCENT * score)
                    inside = np.flatnonzero(window.astype(bool) & (scores >= rankings[place, which].least))
                    if len(inside):
                        at = candidates[inside]
                        rankings[place, which].add(scores[inside], ids[at], labels[at])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rankings = None, {}
        for batch in batches:
            for number in range(len(batch)):
                row = {name: batch.column(name)[number].as_py() for name in batch.schema.names}
                if block is None or block.number != row["block"]:
                    if block is not None:
                        yield from flushed(block, rankings)
                    block = Block({name: row["anchor_" + name] if name != "block" else row["block"] for name in ANCHORS.names})
                    count = negatives or positives
                    kinds = positives if negatives else 1
                    rankings = {(place, which): _Best(count) for place in range(len(block.ids)) for which in range(kinds)}
                    if negatives:
                        block.whole = [list(scores or ()) + [0] * (positives - len(scores or ())) for scores in row["scores"]]
                        block.has = np.array([[which < len(scores or ()) for which in range(positives)] for scores in row["scores"]])
                        block.positive = np.array(block.whole, dtype=np.float64)
                (other_label if negatives else same_label)(block, rankings, *_unpacked(row))
        if block is not None:
            yield from flushed(block, rankings)

    return rows


def _met(candidates: DataFrame, anchors: DataFrame, blocks: int, shares: int) -> DataFrame:
    """Every block of candidates beside every block of anchors: a task has one of these and a share of those."""
    renamed = anchors.selectExpr(
        "block", *[f"{name} AS anchor_{name}" for name in CANDIDATES.names], *[c for c in anchors.columns if c == "scores"]
    )
    dealt = candidates.selectExpr("*", f"explode(sequence(0, {blocks - 1})) AS block", "xxhash64(ids) AS spread")
    met = dealt.join(renamed, "block").withColumn("part", F.expr(f"int(block * {shares} + pmod(spread, {shares}))"))
    return met.repartitionById(blocks * shares, F.col("part")).drop("spread", "part")


def _ranked(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows of each ranking, out of those that the tasks kept."""
    ranked = found.selectExpr(
        "*", "row_number() OVER (PARTITION BY block, place, which ORDER BY score DESC, id, label) AS rank"
    )
    return ranked.filter(f"rank <= {count}")


def mine(
    table: DataFrame,
    anchor: str,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """Per anchor and positive, the first rows of other labels that score 30 to 90 % of the positive.

    ``anchor`` is the SQL condition for rows that are anchors. Rows without key, label or vector,
    and those with a component that is null or not finite, take no part. A shorter vector is filled
    up with zeros, an empty one scores 0. Equal scores rank by key; repeated rows count as rows each,
    but a row with the anchor's own key is no positive. A positive with a negative score has an
    empty range, one with score 0 has rows with score 0. Scores beyond 64 bits are taken as the
    nearest such number. An empty table gives no row. Other columns are not read.
    """
    whole = f"{quoted(vector)} IS NOT NULL AND NOT exists({quoted(vector)}, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    usable = table.filter(f"{quoted(key)} IS NOT NULL AND {quoted(label)} IS NOT NULL AND {whole}")
    narrow = [f"bigint({quoted(key)}) AS id", f"bigint({quoted(label)}) AS label", f"{quoted(vector)} AS vector"]
    candidates = stored(usable.selectExpr(*narrow).mapInArrow(_candidate_rows(BLOCK_CANDIDATES), CANDIDATES_SQL), "candidates")
    chosen = usable.filter(anchor).selectExpr(*narrow)
    blocks = max(1, -(-chosen.count() // BLOCK_ANCHORS))
    anchors = stored(chosen.repartition(blocks).mapInArrow(_anchor_row, ANCHORS_SQL), "anchors")
    size = candidates.selectExpr("sum(length(vectors)) AS size").first()["size"] or 0
    shares = max(1, -(-size // TASK_BYTES), -(-partitions(table.sparkSession) // blocks))

    first = _met(candidates, anchors, blocks, shares).mapInArrow(_mined_rows(positives, 0), FOUND_SQL)
    best = stored(_ranked(first, positives), "positives")
    scores = best.groupBy("block", "place").agg(F.expr("transform(sort_array(array_agg(struct(rank, score))), x -> x.score) AS scores"))
    by_place = scores.groupBy("block").agg(F.expr("map_from_entries(array_agg(struct(place, scores))) AS scores"))
    with_scores = anchors.join(by_place, "block").withColumn(
        "scores", F.expr("transform(sequence(0, int(length(ids) / 8) - 1), p -> coalesce(scores[p], array()))")
    )
    second = _met(candidates, with_scores, blocks, shares).mapInArrow(_mined_rows(positives, negatives), FOUND_SQL)
    ranked = _ranked(second, negatives)
    named = best.selectExpr(
        "block", "place", "rank - 1 AS which", "anchor_id", "id AS positive_id", "score AS positive_score"
    )
    return named.join(ranked.drop("anchor_id"), ["block", "place", "which"]).selectExpr(
        "anchor_id", "positive_id", "rank", "id AS negative_id", "positive_score", "score AS negative_score"
    )


ORACLE = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
         CAST(list_inner_product(a.vector, r.vector) AS BIGINT) AS score
  FROM given a JOIN given r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id
  WHERE NOT s.alike AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
