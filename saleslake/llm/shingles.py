"""Sets of word shingles as hashed numbers, for a slice of texts at once."""

import numpy as np

from saleslake.llm import arrays

# A-Z become a-z; the white space between words.
LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], np.uint8)
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the first word of each text."""
    inside = ~IS_SPACE[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = inside[begins]
        ends = offsets[1:][offsets[1:] > 0] - 1
        last[ends] = inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = arrays.prefix_hash(data)
    return arrays.span_hash(sums, starts, stops), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, and n + 1 offsets.

    A text of fewer words is one shingle, a text without words has none.
    """
    hashes, at = word_hashes(LOWER[data], offsets)
    size = np.diff(at)
    count = np.where(size >= words, size - words + 1, np.minimum(size, 1))
    text = np.repeat(np.arange(len(size)), count)
    start = arrays.ragged_index(at[:-1], count)
    length = np.minimum(size, words)[text]
    value = length.astype(np.uint64) * _STEP[2]
    for k in range(words):
        used = length > k
        step = (value[used] ^ hashes[start[used] + k]) * _STEP[k % 2]
        value[used] = arrays.mix(step)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[fresh], text[fresh]
    return value, np.searchsorted(text, np.arange(len(size) + 1))
