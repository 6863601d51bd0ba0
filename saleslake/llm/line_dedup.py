"""Line dedup by an exact set-similarity join with prefix filtering.

A line is the set of its words. Words are ordered by rarity, then by hash; two lines of similarity t
share a word among the first |x| - ceil(t |x|) + 1 of each, and for the smaller of them a shorter
prefix is enough. Pairs that share such a word pass the length filter, the positional filter and
a parity filter (128 parity bits bound the symmetric difference from below), and are verified on
their full sets. A line goes if an earlier line (smaller doc_id, then smaller line number) is
similar to it; lines are judged on the input, not on what is left.

Equal sets, told by two hashes of 64 bits, are one class with one posting per word, however many lines
it has. One earlier similar class is enough, so large families are settled first by single
comparisons: each class with the earliest one of the same ``near`` keys, which similar sets are
likely to share. Classes that remain open are joined with all earlier ones on the words of their
prefixes; the keys decide how much work is left to that join, not what it finds. Rarity comes from counts of all words in ``SLOTS`` slots by hash, a table of a fixed size; words
in one slot are ordered by hash, so the order is total, the same in all tasks, and the join exact
whatever the collisions.

Lines without words always stay; a ``min_words`` above 1 also keeps those of fewer different words. Null texts stay null, empty ones
empty; rows without doc_id have no place in the order and keep all lines. Rows that repeat a doc_id
have equal places, so none of them is earlier; each loses the lines of its own text only. Words: A-Z in lower case, runs without white space.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import arrays, bitmaps
from saleslake.llm.quality_crf import split_lines
from saleslake.llm.shingles import LOWER, word_hashes
from saleslake.llm.tables import drop, free_names, stored

SLOTS = 1 << 18
CLASS = ["class", "class2"]  # the two hashes of a set of words


@dataclass(frozen=True)
class Similarity:
    num: int = 80
    den: int = 100
    min_words: int = 1

    def prefix(self, size: np.ndarray) -> np.ndarray:
        return size - -(-size * self.num // self.den) + 1


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def slot_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each slot by its number of words in all texts, rare first."""
    schema = T.StructType().add("slot", T.LongType()).add("n", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column("text"))
            for low, high in arrays.slices(offsets):
                part = LOWER[data[offsets[low] : offsets[high]]]
                hashes, _ = word_hashes(part, offsets[low : high + 1] - offsets[low])
                total += np.bincount(_slot(hashes), minlength=SLOTS)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=schema.names)

    counted = docs.select("text").mapInArrow(run, schema).groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    ranks = np.empty(SLOTS, np.int64)
    ranks[np.lexsort((np.arange(SLOTS), counts))] = np.arange(SLOTS)
    return ranks


def line_sets(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray):
    """Distinct words of each line in the order of rarity, offsets by line, first line of each text."""
    starts, _, first = split_lines(data, offsets)
    hashes, at = word_hashes(LOWER[data], np.append(starts, len(data)))
    line = np.repeat(np.arange(len(starts)), np.diff(at))
    rank = ranks[_slot(hashes)].astype(np.uint64)
    order = np.lexsort((hashes, (line.astype(np.uint64) << np.uint64(18)) | rank))
    hashes, line = hashes[order], line[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])
    hashes, line = hashes[fresh], line[fresh]
    return hashes, np.searchsorted(line, np.arange(len(starts) + 1)), first


_SECOND = np.uint64(0xA0761D6478BD642F)


def _class(hashes: np.ndarray, at: np.ndarray, salt: np.uint64 = np.uint64(0)) -> np.ndarray:  # noqa: B008
    """Hash of each set of words; another salt gives another hash."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(arrays.mix((hashes ^ salt) + np.uint64(1)), dtype=np.uint64)])
    return arrays.mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


PARITY = ["parity0", "parity1"]


def _parities(hashes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """128 bits by hash: whether a set has an odd number of words there."""
    bit, half, found = np.uint64(1) << (hashes & np.uint64(63)), (hashes >> np.uint64(6)) & np.uint64(1), []
    for k in range(len(PARITY)):
        mine = np.where(half == k, bit, np.uint64(0))
        sums = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mine)])
        found.append((sums[at[1:]] ^ sums[at[:-1]]).view(np.int64))
    return found


NEAR = 3  # keys of a set; changes the work, not the result


def _near(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``NEAR`` keys of each set that isn't empty, each of its least words by two random orders."""
    starts = at[:-1][np.diff(at) > 0]
    orders = np.uint64(2) * arrays.mix(np.arange(2 * NEAR).astype(np.uint64) + _SECOND) + np.uint64(1)
    least = lambda k: np.minimum.reduceat((hashes ^ orders[k]) * orders[k], starts)
    if not len(starts):
        return np.zeros((0, NEAR), np.int64)
    return np.stack([arrays.mix(least(2 * k) + arrays.mix(least(2 * k + 1))) for k in range(NEAR)], axis=1).view(np.int64)


LINES = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("text_id", T.LongType())
    .add("line", T.LongType())
    .add("class", T.LongType())
    .add("class2", T.LongType())
    .add("size", T.LongType())
    .add("parity0", T.LongType())
    .add("parity1", T.LongType())
    .add("near", T.ArrayType(T.LongType()))
    .add("prefix", T.ArrayType(T.LongType()))
)


def line_table(docs: DataFrame, ranks, similarity: Similarity) -> DataFrame:
    """A row for every line that takes part: its place, class, size, parity bits, near keys and prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column("text"))
            ids, text_ids = batch.column("doc_id").to_numpy(), batch.column("text_id").to_numpy()
            for low, high in arrays.slices(offsets):
                part = data[offsets[low] : offsets[high]]
                hashes, at, first = line_sets(part, offsets[low : high + 1] - offsets[low], ranks.value)
                size = np.diff(at)
                used = np.flatnonzero(size >= max(similarity.min_words, 1))
                owner = np.repeat(np.arange(high - low), np.diff(first))[used]
                near = _near(hashes, at)[(np.cumsum(size > 0) - 1)[used]]
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * NEAR, pa.int32()), pa.array(near.reshape(-1)))
                count = similarity.prefix(size[used])
                prefix = hashes[arrays.ragged_index(at[:-1][used], count)].view(np.int64)
                listed = pa.ListArray.from_arrays(pa.array(arrays.offsets_of(count), pa.int32()), pa.array(prefix))
                place = [ids[low + owner], text_ids[low + owner], used - first[owner]]
                sets = [_class(hashes, at), _class(hashes, at, _SECOND), size, *_parities(hashes, at)]
                plain = map(pa.array, place + [x[used] for x in sets])
                yield pa.RecordBatch.from_arrays([*plain, keys, listed], names=LINES.names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text").mapInArrow(run, LINES)


ID = ["doc_id", "who"]  # of a class: the document of its first line; the line's number and half of the set's hash


def class_table(lines: DataFrame) -> DataFrame:
    """A row for every class: its first line's place, its number of lines, and what the line table has of the set."""
    first = F.min(F.struct("doc_id", "line", "size", *PARITY, "near", "prefix"))
    grouped = lines.groupBy(*CLASS).agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    who = F.col("line") * (1 << 32) + F.col("class").bitwiseAND(F.lit((1 << 32) - 1))
    return grouped.select(*CLASS, "n", "first.*").withColumn("who", who)


def _renamed(end: str, *names: str) -> list[Column]:
    return [F.col(n).alias(f"{n}_{end}") for n in names]


def _before(doc: Column, who: Column) -> Column:
    """Whether the class y stands before a place; equal places have no order."""
    line_y, line = F.shiftright("who_y", 32), F.shiftright(who, 32)
    return (F.col("doc_id_y") < doc) | ((F.col("doc_id_y") == doc) & (line_y < line))


def _may_be_similar(s: Similarity, size_x: Column, size_y: Column) -> Column:
    """False for pairs that can't be similar by their sizes or by the parity bits in which they differ."""
    apart = sum(F.bit_count(F.col(f"{p}_x").bitwiseXOR(F.col(f"{p}_y"))) for p in PARITY)
    fits = s.den * F.least(size_x, size_y) >= s.num * F.greatest(size_x, size_y)
    return fits & ((s.num + s.den) * apart <= (s.den - s.num) * (size_x + size_y))


def _with_partners(classes: DataFrame, s: Similarity) -> DataFrame:
    """Classes whose size lets a different set be similar: of n words, at best n + 1 with all n in common."""
    return classes.where(s.den * F.col("size") >= s.num * (F.col("size") + 1))


def first_candidates(classes: DataFrame, s: Similarity) -> DataFrame:
    """Pairs of each class (x) with the earliest one (y) of each of its near keys, if sizes and parity bits allow."""
    names = (*ID, "size", *PARITY)
    keyed = _with_partners(classes, s).select(*names, F.explode("near").alias("key"))
    least = F.min(F.struct(*names)).alias("least")
    hubs = keyed.groupBy("key").agg(least).select("key", *[F.col(f"least.{c}").alias(f"{c}_y") for c in names])
    pairs = keyed.select("key", *_renamed("x", *names)).join(hubs, "key")
    near = pairs.where(_before(F.col("doc_id_x"), F.col("who_x")) & _may_be_similar(s, F.col("size_x"), F.col("size_y")))
    return near.select(*[f"{c}_{n}" for n in "xy" for c in ID]).distinct()


def candidates(classes: DataFrame, found: DataFrame, s: Similarity) -> DataFrame:
    """Pairs of a class (x) that isn't among the found ones and an earlier one (y) that pass all filters.

    Both sides of the join are one shuffle; so what is found has no place before it, instead of
    being filtered away on one side. The positional filter implies the shorter prefix of the smaller set.
    """
    marked = _with_partners(classes, s).join(found.withColumn("found", F.lit(True)), CLASS, "left")
    words = marked.select(
        "found", *ID, *PARITY, "size", F.posexplode("prefix").alias("at", "word")
    ).select(
        F.col("word").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("word"),  # half of the hash: words that collide only make more candidates
        *ID,
        *PARITY,
        (F.col("size") * (1 << 32) + F.col("at") * 2 + F.col("found").isNull().cast("int")).alias("both"),
    )
    x, y = (words.select("word", *_renamed(n, *ID, *PARITY, "both")) for n in "xy")
    (size_x, at_x), (size_y, at_y) = (
        (F.shiftright(f"both_{n}", 32), F.shiftright(F.col(f"both_{n}").bitwiseAND(F.lit((1 << 32) - 1)), 1)) for n in "xy"
    )
    rest = F.least(size_x - at_x, size_y - at_y)
    limit = F.when(F.col("both_x").bitwiseAND(F.lit(1)) == 1, F.col("doc_id_x")).otherwise(F.lit(-(1 << 63)))
    joined = x.join(y, "word").where(
        _before(limit, F.col("who_x"))
        & ((s.num + s.den) * rest >= s.num * (size_x + size_y))
        & _may_be_similar(s, size_x, size_y)
    )
    return joined.select(*[f"{c}_{n}" for n in "xy" for c in ID]).distinct()


def _full_sets(docs: DataFrame, wanted: DataFrame, similarity: Similarity) -> DataFrame:
    """(id, class, words) of the lines with the given ids.

    Two bitmaps keep other documents from being split and other lines from being shuffled.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(bitmaps.bitmap(wanted, "doc_id"))
    half = F.col("who").bitwiseAND(F.lit((1 << 32) - 1))
    class_bits = spark.sparkContext.broadcast(bitmaps.bitmap(wanted.select(half.alias("half")), "half"))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in (*ID, *CLASS)]).add("words", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.arange(SLOTS)  # the order is of no account here
        for batch in (piece for whole in batches for piece in arrays.pieces(whole, "text")):
            asked = batch.filter(pa.array(bitmaps.contains(bits.value, batch.column("doc_id").to_numpy())))
            data, offsets = arrays.text_bytes(asked.column("text"))
            ids = asked.column("doc_id").to_numpy()
            for low, high in arrays.slices(offsets):
                part = data[offsets[low] : offsets[high]]
                hashes, at, first = line_sets(part, offsets[low : high + 1] - offsets[low], ranks)
                size, sets = np.diff(at), _class(hashes, at)
                chosen = bitmaps.contains(class_bits.value, sets & ((1 << 32) - 1))
                used = np.flatnonzero((size >= max(similarity.min_words, 1)) & chosen)
                owner = np.repeat(np.arange(high - low), np.diff(first))[used]
                flat = hashes[arrays.ragged_index(at[:-1][used], size[used])].view(np.int64)
                listed = pa.ListArray.from_arrays(pa.array(arrays.offsets_of(size[used]), pa.int32()), pa.array(flat))
                who = ((used - first[owner]) << 32) + (sets[used] & ((1 << 32) - 1))
                plain = [ids[low + owner], who, sets[used], _class(hashes, at, _SECOND)[used]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, plain), listed], names=schema.names)

    found = docs.select("doc_id", "text").mapInArrow(run, schema)
    return found.join(wanted, ID, "left_semi").dropDuplicates([*ID, *CLASS])


def similar(docs: DataFrame, pairs: DataFrame, classes: DataFrame, s: Similarity) -> DataFrame:
    """Classes x of those pairs that are similar, from their full sets.

    Where rows repeat a doc_id, an id can name another set that shares half of its hash: every set
    is compared as its own, and only those count whose first line has that id.
    """
    wanted = stored(pairs.selectExpr("doc_id_x doc_id", "who_x who").unionByName(pairs.selectExpr("doc_id_y doc_id", "who_y who")).distinct())
    sets = stored(_full_sets(docs, wanted, s))
    one, two = (sets.select(*_renamed(n, *ID, *CLASS, "words")) for n in "xy")
    both = pairs.join(one, [f"{c}_x" for c in ID]).join(two, [f"{c}_y" for c in ID])
    common = F.size(F.array_intersect("words_x", "words_y"))
    links = both.where(s.den * common >= s.num * (F.size("words_x") + F.size("words_y") - common))
    alike = stored(links.select(*[F.col(f"{c}_x").alias(c) for c in (*ID, *CLASS)]).distinct())
    found = stored(classes.select(*ID, *CLASS).join(alike, [*ID, *CLASS], "left_semi").select(*CLASS))
    for table in (wanted, sets, alike):
        drop(table)
    return found


def later_classes(docs: DataFrame, classes: DataFrame, s: Similarity) -> DataFrame:
    """Classes with an earlier similar one."""
    first = stored(first_candidates(classes, s))
    found = similar(docs, first, classes, s)
    drop(first)
    rest = stored(candidates(classes, found, s))
    more = similar(docs, rest, classes, s)
    drop(rest)
    return found.unionByName(more)


def removed_lines(docs: DataFrame, similarity: Similarity = Similarity()) -> tuple[DataFrame, list[DataFrame]]:  # noqa: B008
    """(doc_id, text_id, line) of every line with an earlier similar line, and the stored tables it reads.

    Lines count from 0. ``text_id`` is Spark's 64-bit hash of the text: it tells texts that share a doc_id apart.
    """
    s, spark = similarity, docs.sparkSession
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks = spark.sparkContext.broadcast(slot_ranks(docs))
    lines = stored(line_table(docs, ranks, s))
    place = F.struct("doc_id", "line")
    classes = stored(class_table(lines))
    wide, lines = lines, stored(lines.select(*CLASS, "doc_id", "text_id", "line"))
    drop(wide)
    later = later_classes(docs, classes, s)
    # A class with an earlier similar one loses all lines, any other class all but its first.
    gone = later.withColumn("gone", F.lit(True))
    marked = stored(classes.join(gone, CLASS, "left").where("n > 1 OR gone").select(*CLASS, place.alias("first_place"), "gone"))
    drop(classes)
    judged = lines.join(marked, CLASS)
    return judged.where(F.col("gone") | (place > F.col("first_place"))).select("doc_id", "text_id", "line"), [lines, marked]


def dedup_lines(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:  # noqa: B008
    """All rows with ``text`` without the removed lines, and ``n_lines``, ``n_removed`` under free names.

    Only documents that may have lost lines are joined with their losses.
    """
    names = free_names(docs, "n_lines", "n_removed")
    removed, read = removed_lines(docs, similarity)
    per_text = removed.groupBy(F.col("doc_id").alias("_id"), F.col("text_id").alias("_text"))
    lost = stored(per_text.agg(F.collect_set(F.col("line").cast("int")).alias("_lost")))
    for table in read:
        drop(table)
    flagged = bitmaps.flagged(docs, "doc_id", lost, "_id")
    same = (F.col("_row.doc_id") == F.col("_id")) & (F.xxhash64("_row.text") == F.col("_text"))
    touched = flagged.where("_maybe").join(lost, same, "left")
    whole = flagged.where("NOT _maybe").select("_row", F.lit(None).cast("array<int>").alias("_lost"))
    both = touched.select("_row", "_lost").unionByName(whole)
    parts = F.split(F.coalesce("_row.text", F.lit("")), "\n", -1)
    # A set difference, not a search in the lost lines for every line.
    places = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), "_lost")
    kept = F.transform(places, lambda i: F.get("_parts", i))
    text = F.when(F.col("_lost").isNull(), F.col("_row.text")).otherwise(F.array_join(kept, "\n"))
    removed = F.when(F.col("_lost").isNull(), F.lit(0)).otherwise(F.size("_lost")).cast("long")
    columns = [text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns]
    split = both.withColumn("_parts", parts)
    return split.select(*columns, F.size("_parts").cast("long").alias(names[0]), removed.alias(names[1]))
