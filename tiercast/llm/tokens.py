"""Token ids of whole texts, encoded once per distinct word.

A word's ids depend on nothing outside it as long as the tokenizer never joins across the
given cuts. Every block of texts is therefore reduced to its distinct words; only those not
met before by the worker are encoded, and the ids are gathered back as arrays.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np

from tiercast.llm import words as W

REMEMBERED = 150_000
AT_ONCE = 8192


class WordIds:
    """Ids of words, with a bounded memory of those met lately.

    ``encode`` gives the ids of words as little-endian unsigned 32-bit numbers. Words not met
    since ``REMEMBERED`` others were are forgotten.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self._encode = encode
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, flat, and how many each has."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        _, first, back = np.unique(W.range_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        data = raw.tobytes()
        distinct = [data[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        here = {w: self._new.get(w) or self._old.get(w) for w in distinct}
        unknown = [w for w, ids in here.items() if ids is None]
        for k in range(0, len(unknown), AT_ONCE):
            part = unknown[k : k + AT_ONCE]
            here.update(zip(part, self._encode(part)))
        self._new.update(here)
        if len(self._new) > REMEMBERED:
            self._old, self._new = self._new, {}
        lists = [here[w] for w in distinct]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), "<u4")
        at = np.cumsum(sizes) - sizes
        lengths = sizes[back]
        return flat[W.spread(at[back], lengths)], lengths


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
