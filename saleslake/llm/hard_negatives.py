"""Hard negatives of anchors by Fagin's threshold algorithm.

Vectors are scaled to whole numbers, and a row's score is its inner product with the anchor. An anchor's
positives are its best other rows of the same label. For each of them a window of scores, a share of
the positive's own score, says how good a row of another label must and may be to be a hard negative.

Rows are sorted by label and read in blocks. A block has one list of its rows per dimension, sorted by
that component. For an anchor each list is read from the end where its component is positive, from the start
where it is negative, and not at all where it is zero (sorted access); rows met for the first time
get their score from the whole vector (random access). The components where reading has arrived bound
the score of every row not met yet. Reading stops when that threshold falls strictly below the k-th
score found, of the positives or of each window, or below a window itself; an equal score could still
belong to a smaller id. What a task has found in earlier blocks counts, so later ones stop sooner.

Anchors come in blocks of a fixed number of bytes, and one block at a time is sent to all tasks, which read all
rows for it: whatever the size of the tables, a task holds one block of each. Blocks of a
label without anchors are skipped for the positives, and so are those of an anchor's own label for
the negatives. Each task returns at most k rows per anchor or window.

Rows without an id, label or vector take no part, nor do those with a component that is null, NaN or infinite.
Rows that repeat an id are one row: that with the smallest label, then the smallest vector.
Components that one of two vectors lacks count as zero, so an empty vector scores 0. Ties go to the smaller
id. Inner products are exact at any size, but a score that is reported must fit a long.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import arrays
from saleslake.llm.tables import stored

ANCHOR_BYTES = 8_000_000  # vectors of one block of anchors
BLOCK_COMPONENTS = 1 << 20  # of one block of rows
FIRST_DEPTH = 32  # rows read from every list before the threshold is looked at; doubled each time


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50  # percent of the positive's score, both ends included
    high: int = 95

    def window(self, score: int) -> tuple[int, int]:
        return -(-self.low * score // 100), self.high * score // 100


def whole_rows(rows: DataFrame, m: Mining, vec_id: str, vector: str, label: str) -> DataFrame:
    """(id, label, v) of the rows that take part, one per id, sorted by label and id."""
    components = F.transform(F.col(vector), lambda x: F.lit(float(m.scale)) * x.cast("double"))
    odd = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), components.alias("v"))
    usable = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~odd)
    place = F.row_number().over(W.partitionBy("id").orderBy("label", "v"))
    one = usable.withColumn("_place", place).where("_place = 1")
    floors = F.transform("v", lambda x: F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0))
    return one.select("id", "label", floors.alias("v")).orderBy("label", "id")


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows, missing components as zeros."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    found = np.zeros((len(column), max(width, int(sizes.max(initial=0)))))
    row = np.repeat(np.arange(len(column)), sizes)
    found[row, np.arange(offsets[0], offsets[-1]) - offsets[:-1][row]] = flat[offsets[0] : offsets[-1]]
    return found


class Block:
    """Rows with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.largest = float(np.abs(vectors).max(initial=0))
        self._exact = None
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, 0)

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | float]]:
        """Places and scores of rows met for the first time, and the bound of all others.

        The first answer has no rows: its bound holds for the whole block.
        """
        n, (vectors, lists, anchor) = len(self.ids), self._numbers(anchor)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        none = np.zeros(0, np.int64)
        if not n:
            return
        if not len(up) and not len(down):
            yield np.arange(n), np.zeros(n, np.int64), -np.inf
            return

        def bound(depth: int) -> int | float:
            return lists[n - 1 - depth, up] @ anchor[up] + lists[depth, down] @ anchor[down]

        yield none, none, bound(0)
        met, depth, step = np.zeros(n, bool), 0, FIRST_DEPTH
        while depth < n:
            upto = min(n, depth + step)
            reached = np.zeros(n, bool)
            reached[self.order[n - upto : n - depth, up].ravel()] = True
            reached[self.order[depth:upto, down].ravel()] = True
            fresh = np.flatnonzero(reached & ~met)
            met[fresh] = True
            yield fresh, vectors[fresh] @ anchor, bound(upto - 1) if upto < n else -np.inf
            depth, step = upto, 2 * step

    def _numbers(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, lists and anchor of one width, as doubles where these are exact, else as Python's whole numbers."""
        width = self.vectors.shape[1]
        anchor = np.concatenate([anchor[:width], np.zeros(max(0, width - len(anchor)))])
        if self.largest * np.abs(anchor).max(initial=0) * max(1, width) < 2**53:
            return self.vectors, self.sorted, anchor
        if self._exact is None:
            whole = np.frompyfunc(int, 1, 1)
            self._exact = whole(self.vectors), whole(self.sorted)
        return *self._exact, np.frompyfunc(int, 1, 1)(anchor)


class Best:
    """The best k of the rows offered so far: larger scores first, then smaller ids."""

    def __init__(self, k: int, low: float = -np.inf, high: float = np.inf):
        self.k, self.low, self.high = k, low, high
        self.found: list[tuple[int, int]] = []  # (-score, id)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        least = max(self.low, -self.found[-1][0]) if len(self.found) == self.k else self.low
        inside = np.flatnonzero((scores >= least) & (scores <= self.high))
        if len(inside):
            ids, scores = ids[inside], scores[inside]
            first = np.lexsort((ids, -scores))[: self.k]
            fresh = [(-int(s), int(i)) for s, i in zip(scores[first], ids[first], strict=True)]
            self.found = sorted(self.found + fresh)[: self.k]

    def closed(self, bound: float) -> bool:
        """Whether no row of a score up to ``bound`` can get in."""
        return bound < self.low or (len(self.found) == self.k and bound < -self.found[-1][0])


@dataclass
class Anchors:
    """One block of anchors."""

    ids: np.ndarray
    labels: list[str]
    vectors: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of a bounded number of components each."""
    for batch in batches:
        vectors = batch.column("v")
        widest = max(1, int(np.diff(vectors.offsets.to_numpy()).max(initial=0)))
        size = max(1, BLOCK_COMPONENTS // widest)
        for low in range(0, batch.num_rows, size):
            part = batch.slice(low, size)
            labels = np.array(part.column("label").to_pylist(), object)
            yield part.column("id").to_numpy(), labels, matrix(part.column("v"))


def _search(block: Block, anchor: np.ndarray, bests: list[Best], allowed: np.ndarray | None) -> None:
    """Offer rows of a block to those that are still open, until all are closed."""
    for places, scores, bound in block.read(anchor):
        if len(places):
            if allowed is not None:
                usable = allowed[places]
                places, scores = places[usable], scores[usable]
            for best in bests:
                best.offer(block.ids[places], scores)
        if all(best.closed(bound) for best in bests):
            return


POSITIVES = T.StructType().add("anchor_id", T.LongType()).add("positive_id", T.LongType()).add("positive_score", T.LongType())
NEGATIVES = (
    T.StructType()
    .add("anchor_id", T.LongType())
    .add("positive_score", T.LongType())
    .add("negative_id", T.LongType())
    .add("negative_score", T.LongType())
)


def find_positives(rows: DataFrame, anchors: Anchors, k: int) -> DataFrame:
    """The best k other rows of the same label for every anchor."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        by_label: dict[str, list[int]] = {}
        for i, label in enumerate(a.labels):
            by_label.setdefault(label, []).append(i)
        best = [Best(k) for _ in a.ids]
        for ids, labels, vectors in _blocks(batches):
            for label in by_label.keys() & set(labels):
                mine = np.flatnonzero(labels == label)
                block = Block(ids[mine], vectors[mine])
                for i in by_label[label]:
                    _search(block, a.vectors[i], [best[i]], block.ids != a.ids[i])
        found = [(int(i), other, -s) for i, b in zip(a.ids, best, strict=True) for s, other in b.found]
        yield _batch(found, POSITIVES)

    top = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id"))
    return rows.mapInArrow(run, POSITIVES).withColumn("_rank", top).where(F.col("_rank") <= k).drop("_rank")


def find_negatives(rows: DataFrame, anchors: Anchors, positives: list[tuple[int, int]], m: Mining) -> DataFrame:
    """The best rows of other labels in the window of every (anchor, positive score)."""
    scores: dict[int, set[int]] = {}
    for anchor_id, score in positives:
        scores.setdefault(anchor_id, set()).add(score)
    shared = rows.sparkSession.sparkContext.broadcast((anchors, scores))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, wanted = shared.value
        best = [
            {s: Best(m.negatives, low, high) for s in wanted.get(int(i), ()) for low, high in [m.window(s)] if low <= high}
            for i in a.ids
        ]
        for ids, labels, vectors in _blocks(batches):
            here = set(labels)
            block, others = Block(ids, vectors), {}
            for i, label in enumerate(a.labels):
                if not best[i] or here == {label}:
                    continue
                if label in here and label not in others:
                    others[label] = labels != label
                _search(block, a.vectors[i], list(best[i].values()), others.get(label))
        found = [
            (int(i), score, other, -s) for i, windows in zip(a.ids, best, strict=True) for score, b in windows.items() for s, other in b.found
        ]
        yield _batch(found, NEGATIVES)

    place = W.partitionBy("anchor_id", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = rows.mapInArrow(run, NEGATIVES).withColumn("rank", F.row_number().over(place))
    return ranked.where(F.col("rank") <= m.negatives)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=schema.names)


def mine(
    rows: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    m: Mining = Mining(),  # noqa: B008
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores, for all anchors.

    ``anchor`` is a condition on ``id`` that says which rows are anchors.
    """
    spark = rows.sparkSession
    ready = stored(whole_rows(rows, m, vec_id, vector, label))
    chosen = ready.where(anchor)
    n, width = chosen.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(1, -(-n * (width or 1) * 8 // anchor_bytes))
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for number in range(blocks if n else 0):
        part = chosen.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow().combine_chunks()
        if not part.num_rows:
            continue
        vectors = matrix(part.column("v").combine_chunks())
        anchors = Anchors(part.column("id").to_numpy(), part.column("label").to_pylist(), vectors)
        positives = stored(find_positives(ready, anchors, m.positives))
        listed = [(r.anchor_id, r.positive_score) for r in positives.select("anchor_id", "positive_score").distinct().collect()]
        negatives = stored(find_negatives(ready, anchors, listed, m))
        found = positives.join(negatives, ["anchor_id", "positive_score"])
        out = out.unionByName(found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    return out
