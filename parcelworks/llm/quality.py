"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each whole text gives a vector of transformed statistics (shares of kinds of characters, lengths
of words and lines, repetition). Per class the labelled vectors' mean and covariance are summed up
where they lie; only the sums come together. Covariances shrink towards the pooled one and towards
its mean variance, and their Cholesky factors are kept. A score is the logistic of the difference
of the classes' log densities, from the Mahalanobis distances, and log priors, times a scale. As the
statistics are far from independent, the scale is at most 1, and the likeliest by all labelled rows.
"""

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.ordering import new_folder
from parcelworks.llm.scan import Words, free_name, runs_hash, slices, text_bytes

THRESHOLD = 0.7
SHRINK_TO_POOLED = 0.2
SHRINK_TO_SPHERE = 0.05
#: scales of the log odds to choose from
SCALES = np.geomspace(1 / 1024, 1, 200)
STATISTICS = (
    "log_chars", "upper", "digit", "symbol", "punctuation", "space", "other_byte", "word_length",
    "word_length_spread", "log_line_words", "one_kind_words", "stops", "repeated_words", "repeated_lines",
    "top_symbol", "lone_symbols",
)

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[ord(c) for c in ".,;:?'\"-()"]] = 4
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_KIND[128:] = 6


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between offsets."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text; a text without characters is a row of zeros."""
    words = Words(data, offsets)
    size = np.diff(offsets).astype(np.float64)
    n_words = np.diff(words.bounds).astype(np.float64)
    kind = _KIND[data]
    counts = {k: _per_text(kind == k, offsets) for k in (1, 2, 3, 4, 5, 6)}
    length = (words.ends - words.starts).astype(np.float64)
    texts, per_word = np.maximum(size, 1), np.maximum(n_words, 1)
    mean = _per_text(length, words.bounds) / per_word
    spread = np.sqrt(np.maximum(0, _per_text(length**2, words.bounds) / per_word - mean**2))
    line_feeds = np.flatnonzero(data == 10)
    lines = np.diff(np.searchsorted(line_feeds, offsets)) + 1.0
    symbols = np.concatenate([[0], np.cumsum(kind == 5)])
    in_word = symbols[words.ends] - symbols[words.starts]
    alone = _per_text(in_word == length, words.bounds) / per_word
    with_symbol = _per_text(in_word > 0, words.bounds) / per_word
    capitals = np.concatenate([[0], np.cumsum(kind == 2)])
    shouted = _per_text((capitals[words.ends] - capitals[words.starts] > 0.5 * length) & (length > 1), words.bounds)
    last = data[words.ends - 1] if len(words.ends) else np.zeros(0, dtype=np.uint8)
    stops = _per_text(last == ord("."), words.bounds) / per_word
    distinct = np.zeros(len(size))
    top = np.zeros(len(size))
    for text, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
        if a < b:
            distinct[text] = len(np.unique(words.hash[a:b]))
            some = data[offsets[text] : offsets[text + 1]]
            some = np.bincount(some[_KIND[some] == 5], minlength=1)
            top[text] = some.max()
    line_starts = np.union1d(line_feeds + 1, offsets[:-1][size > 0])
    line_starts = line_starts[line_starts < len(data)]
    # a line without words has the hash of none
    line_words = np.searchsorted(words.starts, np.append(line_starts, len(data)))
    line_hash = runs_hash(words.hash, line_words[:-1], line_words[1:])
    repeated_lines = np.zeros(len(size))
    edges = np.searchsorted(line_starts, offsets)
    for text, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if b - a > 1:
            repeated_lines[text] = 1 - len(np.unique(line_hash[a:b])) / (b - a)
    root = lambda share: np.arcsin(np.sqrt(np.clip(share, 0, 1)))
    columns = [
        np.log1p(size), root(counts[2] / texts), root(counts[3] / texts), root(counts[5] / texts),
        root(counts[4] / texts), root(counts[1] / texts), root(counts[6] / texts), np.log1p(mean),
        np.log1p(spread), np.log1p(n_words / lines), root(shouted / per_word), root(stops),
        root(1 - distinct / per_word), root(repeated_lines), root(top / texts), root(np.maximum(alone, with_symbol)),
    ]
    return np.where(size[:, None] > 0, np.stack(columns, axis=1), 0.0)


@dataclass(frozen=True)
class Model:
    """Means, Cholesky factors, log determinants and log priors of the classes 0 and 1; scale of the log odds."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    scale: float = 1.0

    def log_odds(self, vectors: np.ndarray) -> np.ndarray:
        density = []
        for mean, factor, log_det, prior in zip(self.means, self.factors, self.log_dets, self.log_priors):
            # the factors' inverses are cached, so a distance is one product
            white = (vectors - mean) @ factor
            density.append(prior - 0.5 * (log_det + (white**2).sum(axis=1)))
        return density[1] - density[0]

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.log_odds(vectors), -50, 50)))


def _statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            rows = list(statistics(*text_bytes(part.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "vector"]
            )


def _class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class the number, sum and sum of products of a task's vectors."""
    width = len(STATISTICS)
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        if not len(batch):
            continue
        vectors = np.array(batch.column("vector").to_pylist())
        labels = np.array(batch.column("label").to_pylist())
        for label in np.unique(labels).tolist():
            some = np.hstack([np.ones((np.sum(labels == label), 1)), vectors[labels == label]])
            sums[label] = sums.get(label, np.zeros((width + 1, width + 1))) + some.T @ some
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([list(m.ravel()) for m in sums.values()], pa.list_(pa.float64()))],
        ["label", "moments"],
    )


def _losses(model: Model) -> Callable:
    """Per scale the sum of a task's losses, the negative log likelihoods of its labels."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        losses = np.zeros(len(SCALES))
        for batch in batches:
            if not len(batch):
                continue
            odds = model.log_odds(np.array(batch.column("vector").to_pylist()))
            against = np.where(batch.column("label").to_numpy(zero_copy_only=False) == 1, -odds, odds)
            losses += [np.logaddexp(0, scale * against).sum() for scale in SCALES]
        yield pa.RecordBatch.from_arrays([pa.array([losses.tolist()], pa.list_(pa.float64()))], ["losses"])

    return rows


def scaled(model: Model, known: DataFrame) -> Model:
    """The model with the likeliest scale by all rows of (vector, label); only sums come to the driver."""
    sums = known.mapInArrow(_losses(model), "losses array<double>")
    losses = np.zeros(len(SCALES))
    for row in sums.selectExpr("posexplode(losses) AS (place, loss)").groupBy("place").agg(F.sum("loss").alias("loss")).collect():
        losses[row["place"]] = row["loss"]
    return replace(model, scale=float(SCALES[np.argmin(losses)]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Model:
    """The model of all labelled documents; of their statistics two matrices and the losses by scale come to the driver.

    Labels other than 0 and 1, null ones, and documents that are not labelled are left out. A
    class without documents has the other's mean and covariance, a prior as of one document, and
    leaves the scale at 1.
    Without any labelled document every text is accepted with a score of 1.
    """
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    vectors = narrow.mapInArrow(_statistic_rows, "doc_id long, vector array<double>")
    marks = labels.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(label)).cast("int").alias("label"))
    known = vectors.join(marks.filter("label IN (0, 1)"), "doc_id").select("vector", "label")
    # read twice, so kept; as large as the labelled rows times the statistics
    folder = new_folder(docs.sparkSession, "quality-vectors")
    known.write.parquet(folder)
    known = docs.sparkSession.read.schema("vector array<double>, label int").parquet(folder)
    size = len(STATISTICS) + 1
    sums = known.mapInArrow(_class_sums, "label int, moments array<double>")
    total = (
        sums.selectExpr("label", "posexplode(moments) AS (place, value)").groupBy("label", "place").agg(F.sum("value").alias("value"))
    )
    moments = np.zeros((2, size * size))
    for row in total.collect():
        moments[row["label"], row["place"]] = row["value"]
    model = model_of(moments.reshape(2, size, size))
    return scaled(model, known) if moments[:, 0].all() else model


def model_of(moments: np.ndarray, to_pooled: float = SHRINK_TO_POOLED, to_sphere: float = SHRINK_TO_SPHERE) -> Model:
    """The model from each class's sums of (1, vector) outer products."""
    counts = moments[:, 0, 0]
    width = moments.shape[1] - 1
    if not counts.sum():
        nothing = np.zeros((2, width))
        return Model(nothing, np.zeros((2, width, width)), nothing[:, 0], np.array([-1000.0 * width, 0.0]))
    means, spreads = [], []
    for one, other in ((0, 1), (1, 0)):
        use = moments[one] if counts[one] else moments[other]
        mean = use[0, 1:] / use[0, 0]
        means.append(mean)
        spreads.append(use[1:, 1:] / use[0, 0] - np.outer(mean, mean))
    pooled = (counts[0] * spreads[0] + counts[1] * spreads[1]) / counts.sum()
    floor = 1e-6 + np.diag(pooled).mean()
    factors, log_dets = [], []
    for spread in spreads:
        shrunk = (1 - to_pooled) * spread + to_pooled * pooled
        scale = np.diag(np.diag(pooled)) + 1e-2 * floor * np.eye(width)
        shrunk = (1 - to_sphere) * shrunk + to_sphere * scale
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower).T)
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    priors = np.log(np.maximum(counts, 1) / np.maximum(counts, 1).sum())
    return Model(np.array(means), np.array(factors), np.array(log_dets), priors)


def _score_rows(model: Model, threshold: float, names: list[str], text: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                scores = model.scores(statistics(*text_bytes(part.column(text))))
                arrays = [part.column(name) for name in names] + [
                    pa.array(scores), pa.array((scores >= threshold).astype(np.int32))
                ]
                yield pa.RecordBatch.from_arrays(arrays, [*names, "score", "predicted"])

    return rows


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    Only the text goes into a score. A null text is scored as an empty one. Columns of these
    names, in any case, that the table already has are replaced; any others are carried.
    """
    names = [name for name in docs.columns if name.lower() not in ("score", "predicted")]
    given_text = free_name(names, "given_text")
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    given = docs.select(*[F.col(quoted(name)) for name in names], F.col(quoted(text)).alias(given_text))
    return given.mapInArrow(_score_rows(model, threshold, names, given_text), f"{fields}, score double, predicted int")


def held_out(key: str = "doc_id") -> str:
    """SQL text: a document is kept from training, by the crc32 of its key as text."""
    return f"coalesce(crc32(CAST({quoted(key)} AS string)) % 4 = 2, false)"


def is_held_out(key: int) -> bool:
    return zlib.crc32(str(key).encode()) % 4 == 2
