"""BPE encoding and decoding by a deterministic automaton over tokens.

**Construction.** The automaton starts with one state and an arc for every byte. For every merge
``u v -> uv``, in order, a gadget is put in: the state behind ``u`` gets a copy without an arc
for ``v``, the arcs of ``u`` lead to that copy, and an arc for ``uv`` goes from every state with an
arc for ``u`` to where ``v`` led. All arcs of a token lead to one state, so the automaton is a
state per token (``target``) and a table of the arcs that states lack (``blocked``), in which
equal rows and columns are kept once.

**Encoding.** Every text has exactly one path of tokens through the automaton, and so has each of
its prefixes. All tokens that a word contains are found by walking a trie from all its positions
at once; then the arcs are followed from left to right, all words of a slice in step. The last
arc into each position tells the path.

**Decoding** emits the labels of the arcs. Bytes that are no UTF-8 become U+FFFD.

A null text is an empty one; an empty text has no tokens. Other columns are carried along; only
the output columns must not exist before.
"""

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from saleslake.llm import arrays, pretokens
from saleslake.llm.tables import free_names
from saleslake.llm.vocabulary import Vocabulary, read_vocabulary


@dataclass(frozen=True)
class Automaton:
    target: np.ndarray  # state behind each token
    column: np.ndarray  # token -> row of blocked
    blocked: np.ndarray  # bit per state: it has no arc for the tokens of that row
    base: np.ndarray  # trie over token bytes as a double array
    check: np.ndarray
    child: np.ndarray
    token: np.ndarray  # trie node -> token or -1
    labels: np.ndarray  # bytes of all tokens, one after the other
    label_at: np.ndarray
    specials: dict[bytes, int]


@functools.cache
def compiled(path: str) -> Automaton:
    return compile_automaton(read_vocabulary(path))


def compile_automaton(vocabulary: Vocabulary) -> Automaton:
    target, blocked = _merge_gadgets(vocabulary)
    rows: dict[bytes, int] = {}
    column = np.array([rows.setdefault(row.tobytes(), len(rows)) for row in blocked], np.int32)
    kept = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    base, check, child, token = _trie(vocabulary)
    joined = np.frombuffer(b"".join(vocabulary.labels), np.uint8)
    label_at = arrays.offsets_of(np.array([len(x) for x in vocabulary.labels]))
    return Automaton(
        target, column, kept, base, check, child, token,
        joined, label_at, vocabulary.specials,
    )


def _merge_gadgets(v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    n = len(v.labels)
    blocked = np.zeros((n, 256), np.uint8)  # token by state, a bit each
    target = np.zeros(n, np.int32)
    uses = {0: 256}
    states, seen = 1, int(v.byte_ids.max()) + 1  # ids of merges mostly ascend
    for u, w, uw in zip(v.left.tolist(), v.right.tolist(), v.merged.tolist(), strict=True):
        seen = max(seen, uw + 1)
        behind, beyond = int(target[u]), int(target[w])
        if blocked[w, behind >> 3] >> (behind & 7) & 1:
            blocked[uw] = 255  # never applies
            continue
        target[uw] = beyond
        uses[beyond] += 1
        if uses[behind] > 1:
            uses[behind] -= 1
            state, states = states, states + 1
            if state >> 3 == blocked.shape[1]:
                blocked = np.concatenate([blocked, np.zeros_like(blocked)], axis=1)
            uses[state] = 1
            target[u] = state
            copied = (blocked[:seen, behind >> 3] >> (behind & 7)) & 1
            blocked[:seen, state >> 3] |= copied << (state & 7)
            behind = state
        blocked[w, behind >> 3] |= 1 << (behind & 7)
        blocked[uw] = blocked[u]
    return target, blocked[:, : (states + 7) >> 3]


def _trie(v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    special = set(v.specials.values())
    children: list[dict[int, int]] = [{}]
    token = [-1]
    for i, label in enumerate(v.labels):
        if i in special or not label:
            continue
        node = 0
        for byte in label:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                token.append(-1)
            node = children[node][byte]
        token[node] = i
    size = 1 << (4 * len(children)).bit_length()  # sparse: nearly every node fits at once
    check, child = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    base = np.zeros(len(children), np.int32)
    for node in sorted((i for i, c in enumerate(children) if c), key=lambda i: -len(children[i])):
        edges = np.array(list(children[node]))
        at = node * 2654435761 % (size - 256)
        while (check[at + edges] >= 0).any():
            at = (at + 97) % (size - 256)
        base[node] = at
        check[at + edges] = node
        child[at + edges] = list(children[node].values())
    return base, check, child, np.array(token, np.int32)


def encode_words(a: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Tokens of words that are neither special nor empty: flat ids and how many each word has."""
    lengths = ends - starts
    first = arrays.offsets_of(lengths + 1)[:-1]  # a place in front of each byte, and one at the end
    text = data[arrays.ragged_index(starts, lengths)]
    place = arrays.ragged_index(first, lengths)
    left = np.repeat(lengths, lengths) - (place - np.repeat(first, lengths))
    at, size, token = _arcs(a, text, left)
    offset = (place - np.repeat(first, lengths))[at]
    narrow = offset.astype(np.uint16) if lengths.max() < 65536 else offset  # sorted by radix
    order = np.argsort(narrow, kind="stable")
    source, size, token = place[at[order]], size[order], token[order]
    steps = np.searchsorted(offset[order], np.arange(int(lengths.max()) + 1))
    places = int((lengths + 1).sum())
    state, came, by = np.zeros(places, np.int32), np.zeros(places, np.int32), np.zeros(places, np.int32)
    for low, high in zip(steps[:-1], steps[1:], strict=True):
        here, arc = state[source[low:high]], token[low:high]
        open_ = (a.blocked[a.column[arc], here >> 3] >> (here & 7) & 1) == 0
        arc, length = arc[open_], size[low:high][open_]
        end = source[low:high][open_] + length
        state[end], came[end], by[end] = a.target[arc], length, arc
    on_path = np.zeros(places, bool)
    last = first + lengths
    now = last
    while len(now):
        on_path[now] = True
        now = now - came[now]
        now = now[came[now] > 0]
    found = np.flatnonzero(on_path)
    counts = np.searchsorted(found, last, side="right") - np.searchsorted(found, first)
    return by[found], counts


def _arcs(a: Automaton, text: np.ndarray, left: np.ndarray):
    """All tokens in the words: place of the first byte, length, id."""
    found = []
    at, node = np.arange(len(text)), np.zeros(len(text), np.int32)
    depth = 0
    while len(at):
        slot = a.base[node] + text[at + depth]
        inside = a.check[slot] == node
        at, node = at[inside], a.child[slot[inside]]
        depth += 1
        token = a.token[node]
        full = token >= 0
        found.append((at[full], np.full(int(full.sum()), depth, np.int32), token[full]))
        more = left[at] > depth
        at, node = at[more], node[more]
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def encode_slice(a: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and n + 1 offsets. Each distinct word is encoded once."""
    starts, ends, special = pretokens.words(data, pretokens.cut_points(data, offsets), a.specials)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    sums = arrays.prefix_hash(data)
    key = arrays.span_hash(sums, starts, ends)
    plain = special < 0
    _, once, which = np.unique(key[plain], return_index=True, return_inverse=True)
    ids, counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
    if len(once):
        ids, counts = encode_words(a, data, starts[plain][once], ends[plain][once])
    ids = np.append(ids, special[~plain])
    counts = np.append(counts, np.ones(int((~plain).sum()), np.int64))
    index = np.zeros(len(starts), np.int64)
    index[plain] = which
    index[~plain] = len(once) + np.arange(int((~plain).sum()))
    size = counts[index]
    flat = ids[arrays.ragged_index(arrays.offsets_of(counts)[index], size)].astype(np.uint32)
    words_before = np.searchsorted(starts, offsets)
    return flat, arrays.offsets_of(size)[words_before]


def decode_ids(a: Automaton, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Text of each run of ids."""
    size = np.diff(a.label_at)[ids]
    data = a.labels[arrays.ragged_index(a.label_at[ids], size)]
    at = arrays.offsets_of(size)[offsets]
    raw = arrays.binary_column(data, at)
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def _extended(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    """Schema with further columns, under free names."""
    names = free_names(df, *(name for name, _ in fields))
    added = [T.StructField(name, kind) for name, (_, kind) in zip(names, fields, strict=True)]
    return T.StructType([*df.schema.fields, *added])


def encode(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", count: str = "n_tokens"
) -> DataFrame:
    """Add the token ids of a text column, packed as little-endian unsigned 32-bit, and their number."""
    automaton = df.sparkSession.sparkContext.broadcast(compiled(vocabulary))
    schema = _extended(df, (ids, T.BinaryType()), (count, T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton.value
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(text))
            for low, high in arrays.slices(offsets):
                part = data[offsets[low] : offsets[high]]
                flat, at = encode_slice(a, part, offsets[low : high + 1] - offsets[low])
                packed = arrays.binary_column(flat.astype("<u4").view(np.uint8), at * 4)
                rows = batch.slice(low, high - low)
                columns = [*rows.columns, packed, pa.array(np.diff(at))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of packed token ids."""
    automaton = df.sparkSession.sparkContext.broadcast(compiled(vocabulary))
    schema = _extended(df, (text, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton.value
        for batch in batches:
            packed = batch.column(ids).fill_null(b"").cast(pa.large_binary())
            size = np.array([len(x) for x in packed.to_pylist()], np.int64)
            offsets = arrays.offsets_of(size)
            for low, high in arrays.slices(offsets):
                rows = batch.slice(low, high - low)
                raw = b"".join(packed.slice(low, high - low).to_pylist())
                at = (offsets[low : high + 1] - offsets[low]) // 4
                column = decode_ids(a, np.frombuffer(raw, "<u4").astype(np.int64), at)
                yield pa.RecordBatch.from_arrays([*rows.columns, column], names=schema.names)

    return df.mapInArrow(run, schema)


def unpacked(packed: bytes) -> list[int]:
    """Ids of one packed value."""
    return np.frombuffer(packed, "<u4").tolist()
