"""Passages of a benchmark inside documents, by Wu-Manber search.

Texts become lower-case words with one space around each, so that a run of words is a string. The
windows of all items (13 words, or a shorter item as a whole) are the patterns. For every class of
pattern lengths a shift table over blocks of bytes tells how far the search may jump; where it may
not, the hash bucket of that block names the windows that are compared directly.

Benchmarks are read in blocks of a bounded size, so what tasks hold doesn't grow with them: the
search for one block hands its hits to the search for the next one.

A null text has no words and no hits. Items without words are no patterns. An item without id
marks words as hit but isn't named. Equal items with different ids are all named.
"""

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.tables import drop, free_names, stored

WINDOW = 13
ITEM_BLOCK_BYTES = 2_000_000  # item text searched for at once

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))

HITS = T.ArrayType(T.StructType().add("first", T.LongType()).add("after", T.LongType()))


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


def spaced(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


@dataclass
class LengthClass:
    """Patterns of similar length with their tables."""

    least: int
    block: int
    shift: dict[bytes, int] = field(default_factory=dict)
    buckets: dict[bytes, list[bytes]] = field(default_factory=lambda: defaultdict(list))

    @classmethod
    def of(cls, patterns: list[bytes]) -> "LengthClass":
        least = min(map(len, patterns))
        wanted = math.ceil(math.log(2 * least * len(patterns)) / math.log(8)) + 1
        self = cls(least, min(least, max(3, wanted)))
        for p in patterns:
            for end in range(self.block, least + 1):
                block = p[end - self.block : end]
                self.shift[block] = min(least - end, self.shift.get(block, least))
            self.buckets[p[least - self.block : least]].append(p)
        return self

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        shift, block, least = self.shift.get, self.block, self.least
        jump = least - block + 1
        end, size = least, len(text)
        while end <= size:
            step = shift(text[end - block : end], jump)
            if step:
                end += step
                continue
            start = end - least
            for p in self.buckets[text[end - block : end]]:
                if text.startswith(p, start):
                    yield start, p
            end += 1


class Patterns:
    """Windows of one block of items."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int = WINDOW):
        self.items: dict[bytes, set[str]] = defaultdict(set)
        for item_id, text in items:
            words = word_list(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                names = self.items[spaced(words[i : i + window])]
                if item_id is not None:
                    names.add(item_id)
        by_length = defaultdict(list)
        for p in self.items:
            by_length[len(p).bit_length()].append(p)
        self.classes = [LengthClass.of(group) for group in by_length.values()]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of words (first, after last) that are hit, and the items that occur."""
        text, runs, names = spaced(words), [], set()
        for c in self.classes:
            seen, word = 0, 0
            for start, p in c.search(text):
                word += text.count(b" ", seen, start)
                seen = start
                runs.append((word, word + p.count(b" ") - 1))
                names |= self.items[p]
        return runs, names


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for first, after in sorted(runs):
        if found and first <= found[-1][1]:
            found[-1] = (found[-1][0], max(after, found[-1][1]))
        else:
            found.append((first, after))
    return found


def find_items(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """Add ``n_words``, ``hits`` (runs of hit words), ``item_ids`` (sorted as text) and ``n_hit``, under free names.

    With several blocks of items the documents are written with their hits after each but the last,
    so that no task ever holds more than one block's patterns.
    """
    added = free_names(documents, "n_words", "hits", "item_ids", "n_hit")
    named = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("words"))
    size = named.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    ids = T.ArrayType(T.StringType())
    found = documents.select(
        "*",
        F.lit(0).cast("long").alias(added[0]),
        F.array().cast(HITS).alias(added[1]),
        F.array().cast(ids).alias(added[2]),
    )
    for block in range(blocks):
        mine = named.where(F.pmod(F.xxhash64("name", "words"), F.lit(blocks)) == block)
        shared = documents.sparkSession.sparkContext.broadcast(Patterns([(r.name, r.words) for r in mine.toLocalIterator()], window))
        before, found = found, _search(found, text, shared)
        if block + 1 < blocks:
            found = stored(found)
            shared.destroy()
            if block:
                drop(before)
    hit = F.aggregate(added[1], F.lit(0).cast("long"), lambda n, run: n + run["after"] - run["first"])
    return found.withColumn(added[3], hit).withColumn(added[2], F.array_sort(added[2]))


def _search(found: DataFrame, text: str, shared: Broadcast) -> DataFrame:
    names = found.columns
    at_text = names.index(text)
    at_words, at_hits, at_ids = range(len(names) - 3, len(names))
    hit_type = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for batch in batches:
            counts, hits, ids = [], batch.column(at_hits).to_pylist(), batch.column(at_ids).to_pylist()
            for i, value in enumerate(batch.column(at_text)):
                words = word_list(value.as_py())
                counts.append(len(words))
                runs, items = patterns.find(words)
                if runs:
                    before = [(h["first"], h["after"]) for h in hits[i]]
                    hits[i] = [{"first": a, "after": b} for a, b in merged(before + runs)]
                    ids[i] = sorted({*ids[i], *items})
            columns = list(batch.columns)
            columns[at_words] = pa.array(counts, pa.int64())
            columns[at_hits] = pa.array(hits, hit_type)
            columns[at_ids] = pa.array(ids, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(run, found.schema)


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit") -> Column:
    """At least one word in twenty is hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
