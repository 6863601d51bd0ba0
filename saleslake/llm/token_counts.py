"""Token counts of texts by rank-synchronous merging.

The distinct words of a slice of texts lie one after the other in flat arrays of symbols. In each
round every word applies its own lowest-ranked pair, at all places where it occurs from left to
right; the symbols that are left when no word has a pair any more are its tokens.

A null text is an empty one, with no tokens. Special strings inside a text are one token each.
Other columns are carried along; only the output columns must not exist before.
"""

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from saleslake.llm import arrays, pretokens
from saleslake.llm.tables import free_name
from saleslake.llm.vocabulary import read_vocabulary

NO_PAIR = np.int32(2**31 - 1)


@dataclass(frozen=True)
class MergeTable:
    pairs: np.ndarray  # left id << 32 | right id, sorted
    ranks: np.ndarray
    merged: np.ndarray  # by rank
    byte_ids: np.ndarray
    specials: dict[bytes, int]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_PAIR)


@functools.cache
def merge_table(path: str) -> MergeTable:
    v = read_vocabulary(path)
    pairs = (v.left << 32) | v.right
    order = np.argsort(pairs)
    merged = v.merged.astype(np.int32)
    return MergeTable(pairs[order], order.astype(np.int32), merged, v.byte_ids.astype(np.int32), v.specials)


def count_symbols(table: MergeTable, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tokens of each word."""
    lengths = ends - starts
    symbol = table.byte_ids[data[arrays.ragged_index(starts, lengths)]]
    word = np.repeat(np.arange(len(starts)), lengths)
    counts = lengths.copy()
    rank = np.full(len(symbol), NO_PAIR)
    inner = np.flatnonzero(word[:-1] == word[1:])
    rank[inner] = table.rank(symbol[inner], symbol[inner + 1])
    while len(symbol):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        least = np.minimum.reduceat(rank, first)
        size = np.diff(np.append(first, len(word)))
        alive = least < NO_PAIR
        counts[word[first]] = size
        if not alive.all():
            keep = np.repeat(alive, size)
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            least, size = least[alive], size[alive]
            if not len(symbol):
                break
        chosen = rank == np.repeat(least, size)
        follows = np.flatnonzero(chosen[1:] & chosen[:-1]) + 1
        if len(follows):  # like a a a: every second place from the first
            at = np.flatnonzero(chosen)
            opens = np.append(True, np.diff(at) > 1)
            run = np.maximum.accumulate(np.where(opens, at, 0))
            chosen[at[(at - run) % 2 == 1]] = False
        at = np.flatnonzero(chosen)
        symbol[at] = table.merged[rank[at]]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, word, rank = symbol[keep], word[keep], rank[keep]
        now = at - np.arange(len(at))  # the places of the new symbols
        stale = np.unique(np.concatenate([now, now - 1]))
        stale = stale[stale >= 0]
        rank[stale] = NO_PAIR
        stale = stale[stale + 1 < len(word)]
        stale = stale[word[stale] == word[stale + 1]]
        rank[stale] = table.rank(symbol[stale], symbol[stale + 1])
    return counts


def count_slice(table: MergeTable, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text."""
    starts, ends, special = pretokens.words(data, pretokens.cut_points(data, offsets), table.specials)
    if not len(starts):
        return np.zeros(len(offsets) - 1, np.int64)
    key = arrays.span_hash(arrays.prefix_hash(data), starts, ends)
    plain = special < 0
    _, once, which = np.unique(key[plain], return_index=True, return_inverse=True)
    size = np.ones(len(starts), np.int64)
    if len(once):
        size[plain] = count_symbols(table, data, starts[plain][once], ends[plain][once])[which]
    return np.diff(arrays.offsets_of(size)[np.searchsorted(starts, offsets)])


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of a text column."""
    shared = df.sparkSession.sparkContext.broadcast(merge_table(vocabulary))
    schema = T.StructType([*df.schema.fields, T.StructField(free_name(df, count), T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(text))
            parts = [
                count_slice(table, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                for low, high in arrays.slices(offsets)
            ]
            counts = pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=schema.names)

    return df.mapInArrow(run, schema)
