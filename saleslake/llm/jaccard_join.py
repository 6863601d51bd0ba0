"""Exact Jaccard join of shingle sets by partitioning the universe of shingles.

Sets fall into bands of sizes. Within a band two sets that link differ in at most H elements, so
when the universe is dealt into H + 1 segments, they agree on one segment at least (pigeonhole). A
set's key for a segment is a hash of its elements there; sets of the next larger band also have keys
under the smaller band's segments. Two sets that share nothing often agree on a segment in which neither has
an element. A set with more filled segments than elements that a partner may not share agrees with each
partner on a filled one; its empty segments have keys that no other set has.

* Equal sets are one class, whatever their number; only classes have keys.
* Proposed pairs must pass the sizes and a parity filter, 512 bits of each set that bound the
  difference of two sets from below; they are verified on the true sets.
* Every key with several classes proposes each class with one of them (a star, not all pairs).
  Verified links make components.
* Keys whose classes lie in different components propose stars around other classes, a few times.
* Only keys whose classes still lie in different components propose the rest of their pairs. If a
  segment's keys would propose more pairs than it costs to index another segment with its
  one-deletion neighbourhoods, it is given up for that other segment: an exchange of one for one
  keeps the pigeonhole. So no link between different texts is lost.

Texts: A-Z become lower case, words are runs without white space. Texts with fewer words than a
shingle are one shingle; a text without words, or null, has an empty set and links with nothing.
``doc_id`` names a document: rows that repeat it are one node. Rows without an id are in nobody's
component and have none.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import arrays, bitmaps
from saleslake.llm.components import components
from saleslake.llm.shingles import shingle_sets
from saleslake.llm.tables import drop, stored

_SALT = np.uint64(0xA0761D6478BD642F)
_COUNT = np.uint64(0xE7037ED1A0B428DB)
TURNS = 3  # stars around other classes before pairs are formed; changes the work, not the result
_TWO = np.uint64(0x8EBC6AF09C88C6E3)


@dataclass(frozen=True)
class Join:
    """words of a shingle; the least similarity as num / den; ratio of the sizes in a band."""

    words: int = 3
    num: int = 90
    den: int = 100
    ratio: float = 1.5

    def bands(self, largest: int) -> np.ndarray:
        """Largest size of each band. In the first one only equal sets link."""
        last = [(self.num - 1) // (self.den - self.num)]
        while last[-1] < largest:
            last.append(max(last[-1] + 1, int(last[-1] * self.ratio), last[-1] * self.den // self.num))
        return np.array(last)

    def segments(self, last: np.ndarray) -> np.ndarray:
        """One more than two sets that link may differ in, and some for those that are likely to be empty."""
        most = last * (self.den - self.num) // self.num
        return most + 1 + np.rint(3 * math.exp(-self.num / (self.den - self.num)) * most).astype(np.int64)

    def difference(self, size: np.ndarray, partner: np.ndarray) -> np.ndarray:
        """Elements, at most, in which sets of these sizes differ if they link."""
        return (self.den - self.num) * (size + partner) // (self.den + self.num)

    def layout(self, size: np.ndarray, own: bool) -> np.ndarray:
        """Band under whose segments a set has keys, own or next smaller; 0 for none."""
        last = self.bands(int(size.max(initial=0)))
        band = np.searchsorted(last, size)
        if own:
            return band
        reach = -(-size * self.num // self.den) <= last[np.maximum(band - 1, 0)]
        return np.where(reach & (band > 1), band - 1, 0)

    def keys(self, value: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all sets, and n + 1 offsets; first those of the own band, then of the smaller one."""
        size = np.diff(at)
        last = self.bands(int(size.max(initial=0)))
        segments = self.segments(last)
        layouts = [self.layout(size, own) for own in (True, False)]
        parts = [np.where(b > 0, segments[b], 0) for b in layouts]
        out = arrays.offsets_of(parts[0] + parts[1])
        found = np.zeros(out[-1], np.uint64)
        whole = _sum_by_set(arrays.mix(value * _TWO), at)
        for k, (band, n) in enumerate(zip(layouts, parts, strict=True)):
            begin = out[:-1] + (parts[0] if k else 0)
            place, element, _ = _place(value, size, band, n, begin)
            sums = np.zeros(out[-1], np.uint64)
            np.add.at(sums, place, element)
            counts = np.bincount(place, minlength=len(sums)).astype(np.uint64)
            mine = arrays.ragged_index(begin, n)
            slot = _slots(band, n)
            key = _key(sums[mine], counts[mine], slot)
            owner, empty = np.repeat(np.arange(len(size)), n), counts[mine] == 0
            partner = np.minimum(last[band], size) if k else size * self.den // self.num
            filled = n - np.bincount(owner[empty], minlength=len(size))
            alone = empty & (filled > self.difference(size, partner))[owner]
            key[alone] = arrays.mix(whole[owner[alone]] ^ (slot[alone].astype(np.uint64) * _COUNT))
            found[mine] = key
        return found, out

    def slots(self, size: np.ndarray) -> np.ndarray:
        """Band and segment of every key, in the order of ``keys``."""
        last = self.bands(int(size.max(initial=0)))
        segments = self.segments(last)
        both = np.stack([self.layout(size, True), self.layout(size, False)], axis=1).reshape(-1)
        return _slots(both, np.where(both > 0, segments[both], 0))


def _slots(band: np.ndarray, n: np.ndarray) -> np.ndarray:
    segment = arrays.ragged_index(np.zeros(len(n), np.int64), n)
    return (np.repeat(band, n) << 40) | segment


def _place(value, size, band, n, begin):
    """Output place and hash of the elements of sets with keys in a band, and their sets."""
    used = np.repeat(n > 0, size)
    owner = np.repeat(np.arange(len(size)), size)[used]
    v = value[used]
    dealt = arrays.mix(v ^ (band[owner].astype(np.uint64) * _SALT)) >> np.uint64(20)
    segment = (dealt % n[owner].astype(np.uint64)).astype(np.int64)
    return begin[owner] + segment, arrays.mix(v * _TWO), owner


def _key(sums: np.ndarray, counts: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return arrays.mix(arrays.mix(sums + counts * _COUNT) ^ (slot.astype(np.uint64) * _SALT))


def deletion_keys(join: Join, value: np.ndarray, size: int, wanted: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """For wanted slots of one set: its own key and the keys without one element; with their slots."""
    keys, slots = [], []
    for own in (True, False):
        band = join.layout(np.array([size]), own)
        if not band[0]:
            continue
        n = join.segments(join.bands(size))[band]
        place, element, _ = _place(value, np.array([size]), band, n, np.zeros(1, np.int64))
        for segment in range(int(n[0])):
            slot = np.array([(int(band[0]) << 40) | segment])
            if int(slot[0]) in wanted:
                mine = element[place == segment]
                total, count = mine.sum(dtype=np.uint64), np.uint64(len(mine))
                sums = np.append(total - mine, total)
                counts = np.append(np.full(len(mine), count - np.uint64(1)), count)
                keys.append(_key(sums, counts, slot))
                slots.append(np.repeat(slot, len(sums)))
    return (np.concatenate(keys), np.concatenate(slots)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _each_slice(batches, text: str, words: int):
    for batch in batches:
        data, offsets = arrays.text_bytes(batch.column(text))
        for low, high in arrays.slices(offsets):
            part = data[offsets[low] : offsets[high]]
            value, at = shingle_sets(part, offsets[low : high + 1] - offsets[low], words)
            yield batch.slice(low, high - low), value, at


def _sum_by_set(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    return sums[at[1:]] - sums[at[:-1]]


PARITY = [f"parity{k}" for k in range(8)]
SUMMARY = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "n", "class", "class2", *PARITY)]
    + [T.StructField("keys", T.ArrayType(T.LongType()))]
)


def _parities(value: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """512 bits by hash: whether a set has an odd number of elements there."""
    place = arrays.mix(value + _COUNT)
    word = (place >> np.uint64(6)) & np.uint64(7)
    bit = np.uint64(1) << (place & np.uint64(63))
    found = []
    for k in range(len(PARITY)):
        mine = np.where(word == k, bit, np.uint64(0))
        sums = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mine)])
        found.append((sums[at[1:]] ^ sums[at[:-1]]).view(np.int64))
    return found


def _may_link(join: Join, one: str, two: str) -> Column:
    """False for pairs that can't link by their sizes, or by the parity bits in which they differ:
    every such bit is an element that only one of both has."""
    a, b = F.col(f"n{one}"), F.col(f"n{two}")
    apart = sum(F.bit_count(F.col(f"{p}{one}").bitwiseXOR(F.col(f"{p}{two}"))) for p in PARITY)
    fits = join.den * F.least(a, b) >= join.num * F.greatest(a, b)
    return fits & ((join.num + join.den) * apart <= (join.den - join.num) * (a + b))


def summaries(docs: DataFrame, join: Join) -> DataFrame:
    """For each row: size of the set, two hashes of the whole set, and its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, value, at in _each_slice(batches, "text", join.words):
            size = np.diff(at)
            spice = size.astype(np.uint64) * _COUNT
            one = arrays.mix(_sum_by_set(arrays.mix(value * _TWO), at) + spice).view(np.int64)
            two = arrays.mix(_sum_by_set(arrays.mix(value ^ _SALT), at) ^ spice).view(np.int64)
            keys, out = join.keys(value, at)
            listed = pa.ListArray.from_arrays(pa.array(out, pa.int32()), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *map(pa.array, (size, one, two, *_parities(value, at))), listed],
                names=SUMMARY.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, SUMMARY)


def _members(rows: DataFrame, join: Join) -> DataFrame:
    """(key, slot, class) for keys that several classes have, each once."""
    exploded = rows.where("n > 0").select(F.explode("keys").alias("key"), "class")
    shared = exploded.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high")
    bits = rows.sparkSession.sparkContext.broadcast(bitmaps.bitmap(shared, "key"))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "slot", "class")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("n").to_numpy()
            keys = batch.column("keys")
            flat = keys.flatten().to_numpy()
            counts = keys.value_lengths().to_numpy()
            hit = np.flatnonzero(bitmaps.contains(bits.value, flat))
            row = np.repeat(np.arange(len(size)), counts)[hit]
            columns = [flat[hit], join.slots(size)[hit], batch.column("class").to_numpy()[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    return rows.where("n > 0").select("n", "class", "keys").mapInArrow(run, schema).distinct()


def _stars(members: DataFrame) -> DataFrame:
    least = members.groupBy("key").agg(F.min("class").alias("b"), F.max("class").alias("top")).where("b != top")
    return members.join(least, "key").where("class != b").select(F.col("class").alias("a"), "b").distinct()


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """Pairs (a, b) of nodes whose sets link, from pairs of classes."""
    mine, other = (
        classes.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", *PARITY)]) for x in "ab"
    )
    near = pairs.join(mine, "a").join(other, "b").where(_may_link(join, "_a", "_b"))
    named = stored(near.where("node_a != node_b").select("node_a", "node_b"))
    nodes = named.selectExpr("node_a AS doc_id").unionByName(named.selectExpr("node_b AS doc_id")).distinct()
    sets = stored(_sets(docs, nodes, join).join(nodes, "doc_id", "left_semi"))
    left = sets.select(F.col("doc_id").alias("node_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("node_b"), F.col("shingles").alias("set_b"))
    both = named.join(left, "node_a").join(right, "node_b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    links = both.where((join.den * common >= join.num * union) & (common > 0)).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    found = stored(links.distinct())
    drop(sets)
    drop(named)
    return found


def _sets(docs: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """Shingle sets of (at least) the given nodes."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmaps.bitmap(nodes, "doc_id"))
    schema = T.StructType().add("doc_id", T.LongType()).add("shingles", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in arrays.pieces(whole, "text")):
            asked = batch.filter(pa.array(bitmaps.contains(bits.value, batch.column("doc_id").to_numpy())))
            for rows, value, at in _each_slice([asked], "text", join.words):
                listed = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), listed], names=schema.names)

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(run, schema)


def _rest(members: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Members of keys whose classes lie in different components, with the component."""
    named = members.join(classes.select("class", "node", "n", *PARITY), "class").join(found, "node", "left")
    placed = named.select("key", "slot", "class", "n", *PARITY, F.coalesce("component", "node").alias("component"))
    split = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")
    )
    return placed.join(split.where("low != high").select("key", "members"), "key")


def _exchanges(rest: DataFrame, classes: DataFrame, join: Join) -> tuple[set[int], set[int]]:
    """Slots to give up, and as many of the same bands to index with one-deletion neighbourhoods.

    What comes to the driver is a row per slot with open keys and per band: it grows with the
    size of the largest text, not with their number.
    """
    costs = rest.groupBy("slot").agg(F.sum("members").alias("pairs")).collect()
    if not costs:
        return set(), set()
    largest = classes.agg(F.max("n")).first()[0]
    last = join.bands(largest)
    segments = join.segments(last)
    edges = F.array(*[F.lit(int(x)) for x in last])
    band = F.size(F.filter(edges, lambda e: e < F.col("n")))
    volume = {r.band: r.elements for r in classes.groupBy(band.alias("band")).agg(F.sum("n").alias("elements")).collect()}
    dropped, promoted = set(), set()
    by_slot = {r.slot: r.pairs for r in costs}
    for b in {slot >> 40 for slot in by_slot}:
        n = int(segments[b])
        price = 2 * (volume.get(b, 0) + volume.get(b + 1, 0)) / n  # keys of one more neighbourhood
        order = sorted(range(n), key=lambda s: -by_slot.get((b << 40) | s, 0))
        for hot, cold in zip(order[: n // 2], reversed(order), strict=False):
            if by_slot.get((b << 40) | hot, 0) <= price + by_slot.get((b << 40) | cold, 0):
                break
            dropped.add((b << 40) | hot)
            promoted.add((b << 40) | cold)
    return dropped, promoted


def _neighbourhoods(docs: DataFrame, classes: DataFrame, join: Join, wanted: set[int]) -> DataFrame:
    """(key, slot, class) of the wanted slots with one-deletion neighbourhoods."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "slot", "doc_id")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, value, at in _each_slice(batches, "text", join.words):
            ids = rows.column("doc_id").to_numpy()
            for i in range(len(ids)):
                mine = value[at[i] : at[i + 1]]
                keys, slots = deletion_keys(join, mine, len(mine), shared.value)
                if len(keys):
                    columns = [keys.view(np.int64), slots, np.full(len(keys), ids[i])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    named = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(run, schema)
    nodes = classes.select(F.col("node").alias("doc_id"), "class")
    members = stored(named.join(nodes, "doc_id").select("key", "slot", "class").distinct())
    several = members.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high")
    return members.join(several.select("key"), "key", "left_semi")


def _more_stars(rest: DataFrame, join: Join, turn: int) -> DataFrame:
    """Each class of an open key with one class of another component, by a new order in every turn."""
    names = ("class", "component", "n", *PARITY)
    order = F.xxhash64("class", F.lit(turn))
    hub = F.min_by(F.struct(*[F.col(c).alias(f"{c}_b") for c in names]), order)
    hubs = rest.groupBy("key").agg(hub.alias("hub")).select("key", "hub.*")
    spokes = rest.select("key", *[F.col(c).alias(f"{c}_a") for c in names]).join(hubs, "key")
    near = spokes.where((F.col("component_a") != F.col("component_b")) & _may_link(join, "_a", "_b"))
    return near.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def _open_pairs(rest: DataFrame, join: Join) -> DataFrame:
    """Pairs across components that share a key and may link."""
    names = ("class", "component", "n", *PARITY)
    one, two = (rest.select("key", *[F.col(c).alias(f"{c}_{x}") for c in names]) for x in "ab")
    near = one.join(two, "key").where((F.col("component_a") < F.col("component_b")) & _may_link(join, "_a", "_b"))
    return near.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def join_documents(docs: DataFrame, join: Join = Join()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles and component_id of every row of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(summaries(docs, join))
    full = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        full.groupBy("class", "class2", "n").agg(F.min("doc_id").alias("node"), *[F.max(p).alias(p) for p in PARITY])
    )
    members = stored(_members(full, join))
    wide, rows = rows, stored(rows.select("doc_id", "n", "class", "class2"))
    drop(wide)
    links = _verified(docs, _stars(members), classes, join)
    rest = stored(_rest(members, classes, components(links)))
    for turn in range(TURNS):
        if rest.isEmpty():
            break
        links = links.unionByName(_verified(docs, _more_stars(rest, join, turn), classes, join))
        rest = stored(_rest(rest.select("key", "slot", "class"), classes, components(links)))
    dropped, promoted = _exchanges(rest, classes, join)
    if dropped:
        more = stored(_neighbourhoods(docs, classes, join, promoted))
        rest = rest.where(~F.col("slot").isin(list(dropped)))
        links = links.unionByName(_verified(docs, _stars(more), classes, join))
        rest = stored(_rest(rest.select("key", "slot", "class").unionByName(more), classes, components(links)))
    if not rest.isEmpty():
        links = links.unionByName(_verified(docs, _open_pairs(rest, join), classes, join))
    found = components(links)
    placed = classes.join(found, "node", "left").select(
        "class", "class2", "n", F.coalesce("component", "node").alias("of_class")
    )
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("of_class"))
    joined = rows.join(placed, ["class", "class2", "n"], "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
