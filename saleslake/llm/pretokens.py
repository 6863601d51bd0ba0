"""Splitting texts into the words of byte-level BPE, for a whole slice of texts at once.

The words are those of the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
A word starts where the class of characters (letter, number, white space, other) changes; the
rules for a leading space, trailing white space and contractions move a few of these starts.
"""

import functools
import re
import unicodedata

import numpy as np

from saleslake.llm.arrays import SLICE_BYTES

LETTER, NUMBER, SPACE, OTHER = range(4)

# White space of Unicode.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# Letters and numbers of Unicode 16 that older character databases lack.
UNICODE_16 = [
    (0x1C89, 0x1C8A, LETTER), (0xA7CB, 0xA7CD, LETTER), (0xA7DA, 0xA7DC, LETTER),
    (0x105C0, 0x105F3, LETTER), (0x10D40, 0x10D49, NUMBER), (0x10D4A, 0x10D65, LETTER),
    (0x10D6F, 0x10D85, LETTER), (0x10EC2, 0x10EC4, LETTER), (0x11380, 0x11389, LETTER),
    (0x1138B, 0x1138B, LETTER), (0x1138E, 0x1138E, LETTER), (0x11390, 0x113B5, LETTER),
    (0x113B7, 0x113B7, LETTER), (0x113D1, 0x113D1, LETTER), (0x113D3, 0x113D3, LETTER),
    (0x116D0, 0x116E3, NUMBER), (0x11BC0, 0x11BE0, LETTER), (0x11BF0, 0x11BF9, NUMBER),
    (0x13460, 0x143FA, LETTER), (0x16100, 0x1611D, LETTER), (0x16130, 0x16139, NUMBER),
    (0x16D40, 0x16D6C, LETTER), (0x16D70, 0x16D79, NUMBER), (0x18CFF, 0x18CFF, LETTER),
    (0x1CCF0, 0x1CCF9, NUMBER), (0x1E5D0, 0x1E5ED, LETTER), (0x1E5F0, 0x1E5F0, LETTER),
    (0x1E5F1, 0x1E5FA, NUMBER),
]


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    points = (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000))
    table = np.fromiter(points, np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    for first, last, kind in UNICODE_16:
        table[first : last + 1] = kind
    return table


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte position and class of each character of UTF-8 text."""
    table = class_table()
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    classes = table[lead]  # right for ASCII, mended for the rest
    wide = np.flatnonzero(lead >= 0x80)
    if len(wide):
        first, where = lead[wide].astype(np.int64), at[wide]
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        point = first & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            point[more] = (point[more] << 6) | (data[where[more] + k] & 0x3F)
        classes[wide] = table[point]
    return at, classes


def word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte positions at which words start; ``bounds`` are the positions at which texts start.

    Every byte belongs to a word, so a word ends where the next one starts.
    """
    at, kind = characters(data)
    n = len(at)
    if n == 0:
        return np.zeros(0, np.int64)
    opens = np.zeros(n + 1, bool)  # a text starts here; the end counts as such
    opens[np.searchsorted(at, bounds)] = True
    opens[0] = opens[n] = True
    letters = data[at]
    run = opens[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    blank = letters == 0x20
    joined = np.zeros(n, bool)
    joined[1:] = blank[:-1] & ~opens[1:n]
    space = kind == SPACE
    ends_run = np.ones(n, bool)
    ends_run[:-1] = run[1:]
    starts = np.where(space, run | (ends_run & ~opens[1:]), run & ~joined)
    _contractions(letters, kind, opens, run, starts)
    return at[starts]


def _contractions(letters, kind, opens, run, starts) -> None:
    n = len(letters)
    marks = np.flatnonzero((letters == 0x27) & starts & run)
    marks = marks[marks + 1 < n]
    marks = marks[(kind[marks + 1] == LETTER) & ~opens[marks + 1]]
    if not len(marks):
        return
    one = letters[marks + 1]
    within = marks + 2 < n
    after = np.where(within, marks + 2, 0)
    more = within & (kind[after] == LETTER) & ~opens[after]
    two = np.where(more, letters[after], 0)
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
    long |= (one == ord("l")) & (two == ord("l"))
    starts[marks[short | long] + 1] = False
    starts[marks[short & more] + 2] = True
    rest = marks[long] + 3
    rest = rest[rest < n]
    starts[rest[(kind[rest] == LETTER) & ~opens[rest]]] = True


def cut_points(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """Offsets with long texts cut where a word starts in any case: ``x y`` in front of the space."""
    lengths = np.diff(offsets)
    extra = []
    for row in np.flatnonzero(lengths > limit):
        start, end = int(offsets[row]), int(offsets[row + 1])
        while end - start > limit:
            chunk = data[start : min(end, start + 2 * limit)].tobytes()
            found = re.compile(rb"[!-~](?= [!-~])").search(chunk, limit - 1)
            if found is None:
                start += len(chunk) - 2
                continue
            start += found.end()
            extra.append(start)
    return np.sort(np.concatenate([offsets, np.array(extra, np.int64)])) if extra else offsets


def special_spans(data: np.ndarray, offsets: np.ndarray, specials: dict[bytes, int]):
    """Start, length and id of the special strings inside texts, leftmost first, longest wins."""
    found = []
    if specials:
        pattern = re.compile(b"|".join(map(re.escape, sorted(specials, key=len, reverse=True))))
        whole = data.tobytes()
        if any(s in whole for s in specials):
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                found += [(m.start(), len(m[0]), specials[m[0]]) for m in pattern.finditer(whole, a, b)]
    return [np.array(x, np.int64) for x in (zip(*found, strict=True) if found else ([], [], []))]


def words(data: np.ndarray, offsets: np.ndarray, specials: dict[bytes, int]):
    """Starts and ends of all words, and per word the special id or -1."""
    at, length, ids = special_spans(data, offsets, specials)
    bounds = offsets[:-1] if not len(at) else np.unique(np.concatenate([offsets[:-1], at, at + length]))
    bounds = bounds[bounds < len(data)]
    starts = word_starts(data, bounds)
    special = np.full(len(starts), -1, np.int64)
    if len(at):
        inside = np.searchsorted(at, starts, side="right") - 1
        hidden = (inside >= 0) & (starts > at[inside]) & (starts < (at + length)[inside])
        starts = starts[~hidden]
        special = np.full(len(starts), -1, np.int64)
        special[np.searchsorted(starts, at)] = ids
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, special
