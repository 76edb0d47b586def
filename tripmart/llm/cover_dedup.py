"""Substring dedup of word windows by difference-cover anchors.

Anchors are the words whose index in their document, modulo 13, lies in
{0, 1, 3, 9}: any shift between two matching places is a difference of two of
these, so two equal windows of 20 words always hold a common anchor that sits
at a cover position in both, with 8 words from there inside the window.

1. Blocks send the hash of the 8 words at each anchor, once per block; those
   of two or more blocks come back.
2. Around an anchor that is repeated, a match is extended by up to 12 words
   to either side: each window there is identified by the hash of its 20
   words and goes, once per block, to the part of that hash, where all but
   the earliest place are marked.
3. Marked windows cover the words to remove.

Hashes have 64 bits; two of n different windows agree with a probability of
about n^2 / 2^65. Defined results: a NULL text has no words; texts of under
20 words lose nothing; NULL doc_id comes before the others; rows that share a
doc_id follow one another in storage order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.blocks import (
    BLOCK_BYTES,
    Block,
    Words,
    joined,
    pack,
    split_by_part,
    unpack,
    window_hashes,
    words_of,
    write_blocks,
)

PERIOD = 13
COVER = (0, 1, 3, 9)
WINDOW = 20
ANCHOR = WINDOW - PERIOD + 1


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the anchors: cover positions with ANCHOR words left."""
    at = np.arange(len(words.code)) - words.first[words.doc]
    left = words.first[words.doc + 1] - np.arange(len(words.code))
    place = np.flatnonzero(np.isin(at % PERIOD, COVER) & (left >= ANCHOR))
    return place, window_hashes(words.code, ANCHOR)[0][place]


def repeated_in(sorted_values: np.ndarray) -> np.ndarray:
    """Mask of values that have an equal neighbour."""
    if not len(sorted_values):
        return np.zeros(0, bool)
    same = sorted_values[1:] == sorted_values[:-1]
    return np.concatenate([[False], same]) | np.concatenate([same, [False]])


def answer_per_block(blocks, owner: np.ndarray, make):
    """(block, payload) for every message that owns some of the found rows."""
    order = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[order], np.arange(len(blocks) + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        yield blocks[k], make(order[bounds[k]:bounds[k + 1]])


def shared_keys(blocks, payloads):
    """Keys that two or more blocks sent, back to each of them."""
    arrays = [np.frombuffer(p, np.uint64) for p in payloads]
    keys = np.concatenate(arrays)
    owner = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
    order = np.argsort(keys, kind="stable")
    order = order[repeated_in(keys[order])]
    yield from answer_per_block(blocks, owner[order], lambda i: keys[order][i].tobytes())


def _send_anchors(parts: int):
    def message(block: Block):
        keys = np.unique(anchors(words_of(block))[1])
        for part, own in split_by_part(keys, parts):
            yield part, keys[own].tobytes()

    return message


def _send_windows(parts: int):
    def message(block: Block, got):
        words = words_of(block)
        place, keys = anchors(words)
        known = [np.frombuffer(x, np.uint64) for x in got]
        own = np.sort(keys)
        known = np.concatenate([*known, own[repeated_in(own)]])
        place = place[np.isin(keys, known)]
        if not len(place):
            return
        n = len(words.code)
        near = np.zeros(n + 1, np.int32)
        np.add.at(near, np.maximum(place - (WINDOW - ANCHOR), 0), 1)
        np.add.at(near, place + 1, -1)
        index = np.arange(n)
        fits = words.first[words.doc + 1] - index >= WINDOW
        start = np.flatnonzero((np.cumsum(near[:n]) > 0) & fits)
        window = window_hashes(words.code, WINDOW)[0][start]
        order = np.argsort(window, kind="stable")
        again = np.concatenate([[False], window[order][1:] == window[order][:-1]])
        if again.any():  # repeats inside the block need no exchange
            yield block.number % parts, pack(marked=np.sort(start[order[again]]).astype(np.int32))
        first = np.sort(order[~again])
        start, window = start[first], window[first]
        ids = block.order
        for part, own in split_by_part(window, parts):
            at = start[own]
            doc = words.doc[at]
            yield part, pack(key=window[own], id=ids[doc], at=at - words.first[doc],
                             place=at.astype(np.int32))

    return message


def _mark_later(blocks, payloads):
    """Places of windows that also start earlier, back to their blocks."""
    sent = []
    for block, payload in zip(blocks, payloads):
        if "marked" in unpack(payload).column_names:
            yield block, payload
        else:
            sent.append((block, payload))
    if not sent:
        return
    own = np.array([b for b, _ in sent])
    key, doc_id, at, place, owner = joined([p for _, p in sent], "key", "id", "at", "place")
    order = np.lexsort((own[owner], at, doc_id, key))
    later = order[1:][key[order][1:] == key[order][:-1]]
    yield from answer_per_block(own.tolist(), owner[later],
                                lambda i: pack(marked=np.sort(place[later[i]])))


def covered(places: np.ndarray, length: int, size: int) -> np.ndarray:
    """Mask of what windows of ``length`` at ``places`` cover."""
    change = np.zeros(size + length + 1, np.int32)
    np.add.at(change, places, 1)
    np.add.at(change, places + length, -1)
    return np.cumsum(change[:size]) > 0


def marked_places(got) -> np.ndarray:
    arrays = [unpack(x).column("marked").to_numpy() for x in got]
    return np.concatenate(arrays).astype(np.int64) if arrays else np.zeros(0, np.int64)


def _kept_texts(block: Block, words: Words, keep: np.ndarray):
    """Per document, its kept words joined by one space."""
    size = (words.end - words.start + 1)[keep]  # with the byte after the word
    ends = np.cumsum(size)
    index = np.arange(ends[-1] if len(ends) else 0)
    out = block.data[index + np.repeat(words.start[keep] - (ends - size), size)]
    out[ends - 1] = 32
    docs = np.searchsorted(words.doc[keep], np.arange(len(block.ids) + 1))
    limit = np.concatenate([[0], ends])
    for a, b in zip(limit[docs[:-1]], limit[docs[1:]]):
        yield out[a:max(a, b - 1)].tobytes()


def _rows(block: Block, got) -> pa.RecordBatch:
    words = words_of(block)
    remove = covered(marked_places(got), WINDOW, len(words.code))
    per_doc = np.bincount(words.doc[remove], minlength=len(block.ids))
    return pa.RecordBatch.from_arrays(
        [pa.array(block.ids, pa.int64()), pa.array(np.diff(words.first), pa.int64()),
         pa.array(per_doc, pa.int64()),
         pa.array([hashlib.sha256(t).hexdigest() for t in _kept_texts(block, words, ~remove)]),
         pa.array(list(_kept_texts(block, words, ~remove)), pa.binary())],
        ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _digests(block: Block, got) -> pa.RecordBatch:
    return _rows(block, got).select(["doc_id", "n_words", "n_removed", "kept_sha256"])


def cover_dedup(docs: DataFrame, with_text: bool = False,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and the kept text
    itself (UTF-8) on demand."""
    blocks = write_blocks(docs, block_bytes=block_bytes)
    parts = blocks.parts
    repeated = blocks.exchange(blocks.send(_send_anchors(parts)), shared_keys)
    marked = blocks.exchange(blocks.send(_send_windows(parts), repeated), _mark_later)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        return blocks.finish(_rows, schema + ", kept_text binary", marked)
    return blocks.finish(_digests, schema, marked)
