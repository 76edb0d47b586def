"""Two-stage suffix sorting in numpy.

A suffix is *rising* if it is smaller than its successor (the suffix one byte
on), else *falling*. Only rising suffixes are sorted directly, by their first
``depth`` bytes. The falling ones are induced: buckets (by first byte) are
scanned in ascending order, and the predecessors of a bucket's suffixes go,
in that order, to the ends of the falling parts of their own buckets. The
order is right to at least ``depth`` bytes.
"""

from __future__ import annotations

import numpy as np


def rising_suffixes(text: np.ndarray) -> np.ndarray:
    """Mask of suffixes smaller than their successors; the last one is not."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16), append=-1))
    where = np.where(step != 0, np.arange(n), n - 1)
    next_step = np.minimum.accumulate(where[::-1])[::-1]
    return step[next_step] > 0


def needed_suffixes(rising: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted suffixes and, after each falling one, its successors up to the
    first rising one: what induction needs."""
    index = np.arange(len(rising))
    stop = np.where(rising, index, len(rising) - 1)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    change = np.zeros(len(rising) + 1, np.int32)
    at = np.flatnonzero(wanted)
    np.add.at(change, at, 1)
    np.add.at(change, stop[at] + 1, -1)
    return np.cumsum(change[:-1]) > 0


def suffix_array(text: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the wanted suffixes in the order of their first ``depth`` bytes."""
    symbols = np.frombuffer(text, np.uint8)
    rising = rising_suffixes(symbols)
    need = needed_suffixes(rising, wanted)
    direct = np.flatnonzero(need & rising).tolist()
    direct.sort(key=lambda i: text[i:i + depth])
    direct = np.array(direct, np.int64)
    heads = np.searchsorted(symbols[direct], np.arange(257))
    falling = need & ~rising
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if len(text) and falling[-1]:
        induced[symbols[-1]].append(np.array([len(text) - 1]))
    out = []
    for c in range(256):
        parts = induced[c]
        # Runs of c: a falling suffix may be induced from its own bucket.
        k = 0
        while k < len(parts):
            before = parts[k] - 1
            before = before[before >= 0]
            before = before[falling[before] & (symbols[before] == c)]
            if len(before):
                parts.append(before)
            k += 1
        bucket = np.concatenate([*parts, direct[heads[c]:heads[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[falling[before] & (symbols[before] > c)]
        if len(before):
            to = symbols[before]
            order = np.argsort(to, kind="stable")
            bounds = np.searchsorted(to[order], np.arange(257))
            for b in np.flatnonzero(np.diff(bounds)):
                induced[b].append(before[order[bounds[b]:bounds[b + 1]]])
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def adjacent_prefixes(text: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix, up to ``depth``, of each suffix in ``order``
    with the one before it (0 for the first), eight bytes at a time."""
    padded = np.frombuffer(text + bytes(depth + 16), np.uint8)
    words = np.ndarray((len(padded) - 7,), np.dtype("<u8"), padded, strides=(1,))
    common = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for done in range(0, depth, 8):
        if not len(alive):
            break
        differ = words[order[alive] + done] ^ words[order[alive - 1] + done]
        lowest = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) // 8)
        common[alive] += same
        alive = alive[same == 8]
    return np.minimum(common, depth)
