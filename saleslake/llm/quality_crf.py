"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. The score of a line depends on its own features and on those of the
lines before and after it; a matrix holds the scores of neighbouring labels. The marginal
probability of each line, by the forward-backward recursion, is averaged with the lengths of the
lines as weights, and a logistic curve maps that average to the score of the document.

Training takes at most ``SAMPLE_ROWS`` labelled documents of each label, the first by a hash of
their id, with their whole texts; every line has the label of its document.
Scoring covers all lines of all texts. Only the text goes into a score.

A null text is an empty one: one line without words. Without labelled rows of both kinds every
score is 0.5. Repeated rows get the same score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import arrays
from saleslake.llm.tables import free_names

SAMPLE_ROWS = 1000
ROUNDS = 120
RATE = 0.15
PENALTY = 1e-3
OWN = 13  # features of a line itself, the first is 1

# Classes of bytes that the features count.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&<>@=_~^\\{}[]/",
    "bar": b"|",
    "bang": b"!",
    "stop": b".,;:?",
    "wide": bytes(range(0x80, 0x100)),
}
_SPACE = b" \t\n\x0b\f\r"


def _mask(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_MASKS = {name: _mask(members) for name, members in _CLASSES.items()}
_IS_SPACE, _IS_CLOSING = _mask(_SPACE), _mask(b".!?:\"')")


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and the number of the first line of each text."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    owned = np.searchsorted(breaks, offsets)
    first = owned + np.arange(len(offsets))
    return starts, ends, first


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with those of its neighbours, line lengths, first line of each text."""
    starts, ends, first = split_lines(data, offsets)
    n = len(starts)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int32)
        np.cumsum(flags, out=sums[1:])
        return (sums[ends] - sums[starts]).astype(float)

    space = _IS_SPACE[data]
    opens = ~space
    if len(opens):
        opens[1:] &= space[:-1]
        begins = starts[starts < len(data)]
        opens[begins] = ~space[begins]
    size = (ends - starts).astype(float)
    number = {name: count(mask[data]) for name, mask in _MASKS.items()}
    words = count(opens)
    full = np.maximum(words, 1)
    last = np.where(size > 0, np.append(data, 0)[np.maximum(ends - 1, 0)], 0)
    key = arrays.span_hash(arrays.prefix_hash(data), starts, ends)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    again = np.zeros(n, bool)
    order = np.lexsort((np.arange(n), key, text))
    again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    own = np.stack(
        [
            np.ones(n),
            np.log1p(words) / 4,
            np.minimum(size / full / 10, 3),
            np.minimum(number["symbol"] / full, 3),
            np.minimum(number["bar"] / full, 3),
            number["upper"] / np.maximum(number["upper"] + number["lower"], 1),
            number["digit"] / np.maximum(size, 1),
            np.minimum(number["bang"] / full, 3),
            np.minimum(number["stop"] / full, 3),
            _IS_CLOSING[last],
            words == 0,
            again & (words > 0),
            number["wide"] / np.maximum(size, 1),
        ],
        axis=1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([own, before, after], axis=1), size + 1, first


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # score of good minus that of bad, by feature
    pairs: np.ndarray  # scores of neighbouring labels, bad first
    slope: float
    shift: float


def _steps(first: np.ndarray) -> list[np.ndarray]:
    """Numbers of the k-th lines of all texts that have as many, for every k."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, ordered = first[:-1][order], size[order]
    left = np.searchsorted(-ordered, -np.arange(int(size.max(initial=0))), side="left")
    return [begin[: left[k]] + k for k in range(len(left))]


def forward_backward(score: np.ndarray, pairs: np.ndarray, first: np.ndarray):
    """Marginal of good for each line, expected counts of neighbouring labels, sum of log Z."""
    n = len(score)
    node = np.stack([np.zeros(n), score], axis=1)
    ahead, behind = node.copy(), np.zeros((n, 2))
    steps = _steps(first)
    for here in steps[1:]:
        came = ahead[here - 1][:, :, None] + pairs
        ahead[here] += np.logaddexp(came[:, 0], came[:, 1])
    for here in steps[:0:-1]:
        goes = pairs + (node[here] + behind[here])[:, None, :]
        behind[here - 1] = np.logaddexp(goes[:, :, 0], goes[:, :, 1])
    last = ahead[first[1:] - 1]
    z = np.logaddexp(last[:, 0], last[:, 1])
    z_line = np.repeat(z, np.diff(first))
    good = np.exp(np.minimum(ahead[:, 1] + behind[:, 1] - z_line, 0))
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    joint = ahead[at - 1][:, :, None] + pairs + (node[at] + behind[at])[:, None, :] - z_line[at][:, None, None]
    return good, np.exp(np.minimum(joint, 0)).sum(axis=0), z.sum()


def _quality(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    weighed = np.concatenate([[0], np.cumsum(good * size)])
    total = np.concatenate([[0], np.cumsum(size)])
    mean = (weighed[first[1:]] - weighed[first[:-1]]) / (total[first[1:]] - total[first[:-1]])
    bounded = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(bounded / (1 - bounded))


class _Adam:
    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.mean, self.square, self.step = value, rate, value * 0, value * 0, 0

    def move(self, gradient: np.ndarray) -> None:
        self.step += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        mean, square = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.999**self.step)
        self.value = self.value - self.rate * mean / (np.sqrt(square) + 1e-8)


def train(texts: list[str], labels: list[int]) -> Model:
    """Fit on a sample of documents; each line of a document has its label."""
    if len(set(labels)) < 2:
        return Model(np.zeros(3 * OWN), np.zeros((2, 2)), 0.0, 0.0)
    data, offsets = arrays.text_bytes(pa.array(texts, pa.string()))
    features, size, first = line_features(data, offsets)
    per_text = np.repeat(np.array(labels, float), np.diff(first))
    seen_pairs = np.zeros((2, 2))
    inner = np.ones(len(per_text), bool)
    inner[first[:-1]] = False
    for k in (0, 1):
        seen_pairs[k, k] = (inner & (per_text == k)).sum()
    n = len(per_text)
    weights, pairs = _Adam(np.zeros(features.shape[1]), RATE), _Adam(np.zeros((2, 2)), RATE)
    for _ in range(ROUNDS):
        good, expected, _z = forward_backward(features @ weights.value, pairs.value, first)
        weights.move(features.T @ (good - per_text) / n + PENALTY * weights.value)
        pairs.move((expected - seen_pairs) / n + PENALTY * pairs.value)
    good, _, _ = forward_backward(features @ weights.value, pairs.value, first)
    raw, want = _quality(good, size, first), np.array(labels, float)
    curve = _Adam(np.array([1.0, 0.0]), RATE)
    for _ in range(3 * ROUNDS):
        error = _sigmoid(curve.value[0] * raw + curve.value[1]) - want
        curve.move(np.array([(error * raw).mean(), error.mean()]) + PENALTY * curve.value)
    return Model(weights.value, pairs.value, float(curve.value[0]), float(curve.value[1]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def held_out(doc_id: str = "doc_id"):
    """Rows that training never sees: a third by a checksum of the id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Train on documents (doc_id, text) with labels (doc_id, quality): at most ``rows`` of each label, whole texts.

    An id whose labels contradict each other has none. Of documents that repeat an id the smallest
    text counts, a null one as empty. So the same tables give the same model, whatever their order.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out())
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_other"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    clear = agreed.where("quality = _other").drop("_other")
    halves = [clear.where(F.col("quality") == q).orderBy(*order).limit(rows) for q in (0, 1)]
    chosen = halves[0].unionByName(halves[1])  # at most twice ``rows`` small rows
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = sorted(sample.collect(), key=lambda r: r.doc_id)
    return train([r.text or "" for r in found], [r.quality for r in found])


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score", lines: str | None = None) -> DataFrame:
    """Add the score of each text, and on request the marginals of its lines, under free names."""
    names = free_names(df, name, *([lines] if lines else []))
    added = [T.StructField(n, kind) for n, kind in zip(names, (T.DoubleType(), T.ArrayType(T.DoubleType())), strict=False)]
    schema = T.StructType([*df.schema.fields, *added])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(text))
            for low, high in arrays.slices(offsets):
                part = data[offsets[low] : offsets[high]]
                features, size, first = line_features(part, offsets[low : high + 1] - offsets[low])
                good, _, _ = forward_backward(features @ m.weights, m.pairs, first)
                columns = [pa.array(_sigmoid(m.slope * _quality(good, size, first) + m.shift))]
                if lines:
                    columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(good)))
                own = batch.slice(low, high - low).columns
                yield pa.RecordBatch.from_arrays([*own, *columns], names=schema.names)

    return df.mapInArrow(run, schema)
