"""A byte-level BPE vocabulary file as arrays. Read on the driver; tasks get the arrays."""

import functools
import json
from dataclasses import dataclass

import numpy as np


@functools.cache
def _byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: bytes without one are moved up from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


@dataclass(frozen=True)
class Vocabulary:
    labels: list[bytes]  # bytes of each id
    left: np.ndarray  # the merges in their order: ids of both parts and of the result
    right: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray  # id of each single byte
    specials: dict[bytes, int]


@functools.cache
def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    ids, byte_of = parsed["model"]["vocab"], _byte_of()
    specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    labels = [b""] * (1 + max([*ids.values(), *specials.values()]))
    for token, i in ids.items():
        labels[i] = bytes(byte_of[c] for c in token)
    for token, i in specials.items():
        labels[i] = token.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in parsed["model"]["merges"]]
    byte_ids = np.zeros(256, np.int64)
    for c, b in byte_of.items():
        byte_ids[b] = ids[c]
    return Vocabulary(
        labels,
        np.array([ids[a] for a, _ in pairs], np.int64),
        np.array([ids[b] for _, b in pairs], np.int64),
        np.array([ids[a + b] for a, b in pairs], np.int64),
        byte_ids,
        {token.encode(): i for token, i in specials.items()},
    )
