"""Target-distribution importance resampling over hashed word features.

A feature is a run of words; its bucket is the CRC-32 of its UTF-8 bytes modulo the number of
buckets. Counts of all documents and of all target texts give every bucket a gain, the scaled log
of its smoothed target share over its smoothed corpus share. A document's weight is the mean gain
of its features. Gumbel noise that depends on the document's id alone turns the weights into
scores, and the highest scores are a draw without replacement.

The distinct features of a slice are grouped by length into matrices of bytes, a feature a row. One
step per column updates the checksums of a whole matrix, and the buckets are scattered back to the
places of the features. A matrix of very few rows is read row by row instead.

The draw sorts nobody but those who can be drawn: the scores are whole numbers of a narrow range
(counts of 64 bits and 32 bits of noise bound them), so a count per score finds the least score
that gets in. What reaches the driver: one row per bucket, per score and per sort partition.

A null or empty text has no features and weight 0. A null id counts as an empty one in the noise and
comes last among ties. Rows that repeat an id are documents of their own with the same noise; equal
rows are ranked in the order in which they are stored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import arrays
from saleslake.llm.tables import stored

FEW_ROWS = 8  # a matrix of fewer rows is read row by row

# The reversed polynomial of CRC-32, and the bytes of a word.
POLYNOMIAL = 0xEDB88320
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Resampling:
    longest_run: int = 1  # words of the longest feature
    buckets: int = 10_000
    scale: int = 1_000  # gains and noise are whole multiples of 1 / scale
    min_words: int = 20  # documents of fewer words aren't drawn
    percent: int = 10
    seed: int = 2024


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(POLYNOMIAL), crc >> 1)
    return crc


_CRC = _crc_table()


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the distinct rows of a matrix of bytes, and for each row the one that it equals.

    Rows hold no zero byte, so padding and numpy's trailing zeros don't change what is equal.
    """
    length = rows.shape[1]
    if length <= 8:
        wide = np.zeros((len(rows), 8), np.uint8)
        wide[:, :length] = rows
        keys = wide.view(np.uint64).ravel()
    else:
        keys = np.ascontiguousarray(rows).view(f"S{length}").ravel()
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    return first, which


def checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans of ``data``, which hold no zero byte."""
    found = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    sizes, at = np.unique(lengths[order], return_index=True)
    for size, low, high in zip(sizes, at, [*at[1:], len(order)], strict=True):
        places = order[low:high]
        matrix = data[starts[places][:, None] + np.arange(size)]
        first, which = _distinct(matrix)
        rows = matrix[first]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        if len(rows) < FEW_ROWS:
            crc = np.array([_row_checksum(row) for row in rows], np.uint32)
        else:
            for column in np.ascontiguousarray(rows.T):
                crc = _CRC[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            crc = ~crc
        found[places] = crc[which]
    return found


def _row_checksum(row: np.ndarray) -> int:
    import zlib

    return zlib.crc32(row.tobytes())


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of all words, and the number of words before each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = _WORD[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    opens[edge] = inside[edge]
    edge = offsets[1:][offsets[1:] > 0] - 1
    closes[edge] = inside[edge]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1 - starts, np.searchsorted(starts, offsets)


def feature_buckets(data: np.ndarray, offsets: np.ndarray, r: Resampling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all features, in parts of about a slice of bytes each."""
    starts, lengths, before = _words(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    for low, high in arrays.slices(arrays.offsets_of(lengths)):
        last = min(high + r.longest_run - 1, len(starts))
        size = lengths[low:last]
        at = arrays.offsets_of(size + 1)  # a blank after each word, so that a run of words is a span
        line = np.full(at[-1], 0x20, np.uint8)
        line[arrays.ragged_index(at[:-1], size)] = _LOWER[data[arrays.ragged_index(starts[low:last], size)]]
        for run in range(1, r.longest_run + 1):
            first = np.arange(min(high, len(starts) - run + 1) - low)
            first = first[owner[low + first] == owner[low + first + run - 1]]
            crc = checksums(line, at[first], at[first + run] - 1 - at[first])
            yield owner[low + first], (crc % np.uint32(r.buckets)).astype(np.int64)


def bucket_counts(df: DataFrame, text: str, r: Resampling) -> np.ndarray:
    """Features per bucket in all texts: one row per bucket and task, then one per bucket."""
    schema = T.StructType().add("bucket", T.LongType()).add("n", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(r.buckets, np.int64)
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(0))
            for low, high in arrays.slices(offsets):
                part = data[offsets[low] : offsets[high]]
                for _, bucket in feature_buckets(part, offsets[low : high + 1] - offsets[low], r):
                    total += np.bincount(bucket, minlength=r.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=schema.names)

    counted = df.select(F.col(text).alias("text")).mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(r.buckets, np.int64)
    counts[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return counts


def gains(corpus: np.ndarray, target: np.ndarray, r: Resampling) -> np.ndarray:
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + r.buckets) / ((s + 1) * (t.sum() + r.buckets))
    return np.floor(r.scale * np.log(ratio)).astype(np.int64)


SCORED = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("n_words", T.LongType())
    .add("n_features", T.LongType())
    .add("weight", T.LongType())
)


def noise(doc_id: Column, r: Resampling) -> Column:
    """Gumbel noise of a document, a whole multiple of 1 / scale."""
    digest = F.sha2(F.concat(F.lit(f"{r.seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-r.scale * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def score(documents: DataFrame, target: DataFrame, r: Resampling = Resampling(), text: str = "text", doc_id: str = "doc_id", target_text: str = "text") -> DataFrame:  # noqa: B008
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every document."""
    gain = gains(bucket_counts(documents, text, r), bucket_counts(target, target_text, r), r)
    shared = documents.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(1))
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for low, high in arrays.slices(offsets):
                part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                words[low:high] = np.diff(_words(part, at)[2])
                for owner, bucket in feature_buckets(part, at, r):
                    n = np.bincount(owner, minlength=high - low)
                    upto = arrays.offsets_of(shared.value[bucket])
                    ends = np.cumsum(n)
                    features[low:high] += n
                    weight[low:high] += upto[ends] - upto[ends - n]
            weight //= np.maximum(features, 1)
            columns = [batch.column(0), *map(pa.array, (words, features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=SCORED.names)

    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")]
    weighed = documents.select(*columns).mapInArrow(run, SCORED)
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), r))


def draw(scored: DataFrame, r: Resampling = Resampling()) -> DataFrame:  # noqa: B008
    """The scored documents with ``rank``: 1, 2, 3… for the drawn ones, null for the others.

    The ranks follow from a sort by ranges: no key holds more than one row, since the stored place
    of a row ends the order, so that a partition's share never depends on how often a score or an
    id occurs.
    """
    spark = scored.sparkSession
    scored = stored(scored.withColumn("_place", F.monotonically_increasing_id()))
    eligible = F.col("n_words") >= r.min_words
    histogram = scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    scores, counts = histogram["score"].to_numpy(), histogram["n"].to_numpy()
    wanted = r.percent * int(counts.sum()) // 100
    no_rank = F.lit(None).cast("long").alias("rank")
    out = [c for c in scored.columns if c != "_place"]
    if not wanted:
        return scored.select(*out, no_rank)
    down = np.argsort(-scores)
    least = int(scores[down][np.searchsorted(np.cumsum(counts[down]), wanted)])
    inside = eligible & (F.col("score") >= least)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_place")]
    ordered = stored(scored.where(inside).orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(tuple(x) for x in ordered.groupBy(part).count().collect())
    before = np.cumsum([0, *(n for _, n in sizes)])
    offsets = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before, strict=False)], "_part long, _before long")
    rank = F.col("_before") + within + 1
    ranked = ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    drawn = ranked.select(*out, F.when(rank <= wanted, rank).alias("rank"))
    return drawn.unionByName(scored.where(~inside).select(*out, no_rank))


def resample(documents: DataFrame, target: DataFrame, r: Resampling = Resampling(), text: str = "text", doc_id: str = "doc_id", target_text: str = "text") -> DataFrame:  # noqa: B008
    """The drawn documents with all their columns; those without an id can't be found again and are left out."""
    ranked = draw(score(documents, target, r, text, doc_id, target_text), r)
    drawn = stored(ranked.where("rank IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct())
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    kept = documents.select(row).join(drawn, F.col(f"_row.`{doc_id}`").cast("long") == F.col("_id"), "left_semi")
    return kept.select(*[F.col(f"_row.`{c}`") for c in documents.columns])
