"""Suffix-array dedup: bytes of 100-byte strings that also start earlier.

Each window of 100 bytes has an anchor: the 32-byte string inside it with the
smallest hash (leftmost on ties). Equal windows have equal anchors, so it is
enough to sort suffixes among the windows of one anchor, and neighbouring
windows mostly share theirs: a *run* of windows travels as one short segment.

1. Blocks send the anchors they hold; those of two or more blocks come back.
2. Runs with a repeated anchor go to the part of the anchor. Runs that are
   equal byte for byte are sent once per block.
3. In a part, distinct segments are laid end to end and their suffixes sorted
   in two stages (``suffix_array``); windows whose common prefix with their
   neighbour reaches 100 bytes are equal, and all but the earliest are marked.
4. Marked windows cover the bytes to remove.

An anchor with over HOT different surroundings (a line that very many
documents share) is split further: its windows go out one by one to the part
of their own 64-bit hash. That changes where they are compared, not what is
found.

Defined results: a NULL text is empty; texts under 100 bytes lose nothing;
NULL doc_id comes first; rows that share a doc_id follow one another in
storage order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.blocks import (
    BLOCK_BYTES,
    Block,
    byte_window_hashes,
    joined,
    mix,
    pack,
    split_by_part,
    unpack,
    write_blocks,
)
from tripmart.llm.cover_dedup import answer_per_block, repeated_in
from tripmart.llm.suffix_array import adjacent_prefixes, suffix_array

WINDOW = 100
GRAM = 32
#: Different surroundings of an anchor from which its windows travel singly.
HOT = 2048
#: Text that is suffix-sorted at a time; groups of one anchor stay together.
SORT_BYTES = 1 << 18
_PLACE_BITS = np.uint64(31)


class Runs:
    """Maximal runs of neighbouring windows with the same anchor."""

    def __init__(self, block: Block):
        grams, window = byte_window_hashes(block.data, GRAM, WINDOW)
        low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span, have = WINDOW - GRAM + 1, 1  # windows see this many grams
        while 2 * have <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if span > have and len(least) > span - have:
            least = np.minimum(least[:have - span], least[span - have:])
        fits = np.zeros(len(window) + 1, np.int32)
        long = block.ends - block.starts >= WINDOW
        np.add.at(fits, block.starts[long], 1)
        np.add.at(fits, block.ends[long] - WINDOW + 1, -1)
        start = np.flatnonzero(np.cumsum(fits[:-1]) > 0)
        anchor = (least[start] & low).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(start) != 1) | (np.diff(anchor) != 0)
        first = np.flatnonzero(new)
        self.start = start[first]
        self.size = np.diff(first, append=len(start))
        self.key = grams[anchor[first]]
        self.window = window
        self.doc = np.searchsorted(block.ends, self.start)
        last = self.start + self.size - 1
        # windows overlap, so the first, the last and the number give the content
        self.content = (mix(window[self.start] ^ window[last] * np.uint64(0x9E3779B97F4A7C15)
                            + self.size.astype(np.uint64)) if len(first) else self.key)


def _first_of_each(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first occurrence of each value, and of all later ones."""
    order = np.argsort(values, kind="stable")
    again = np.concatenate([[False], values[order][1:] == values[order][:-1]]) \
        if len(values) else np.zeros(0, bool)
    return np.sort(order[~again]), np.sort(order[again])


def _surroundings(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a block and how many different runs each has there."""
    first, _ = _first_of_each(runs.content ^ mix(runs.key.copy()))
    return np.unique(runs.key[first], return_counts=True)


def _send_anchors(parts: int):
    def message(block: Block):
        keys, counts = _surroundings(Runs(block))
        counts = np.minimum(counts, 65535).astype(np.uint16)
        for part, own in split_by_part(keys, parts):
            yield part, pack(key=keys[own], n=counts[own])

    return message


def _shared_anchors(limit: int):
    def work(blocks, payloads):
        """Anchors of two or more blocks, with a flag for those to split."""
        key, n, owner = joined(payloads, "key", "n")
        order = np.argsort(key, kind="stable")
        key, n, owner = key[order], n[order].astype(np.int64), owner[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        hot = (np.add.reduceat(n, np.flatnonzero(new)) > limit)[np.cumsum(new) - 1]
        some = np.flatnonzero(repeated_in(key))
        yield from answer_per_block(blocks, owner[some],
                                    lambda i: pack(key=key[some][i], hot=hot[some][i]))

    return work


def _segments(block: Block, start: np.ndarray, size: np.ndarray) -> pa.Array:
    lengths = size + WINDOW - 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], lengths)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start),
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(block.data[index])])


def _send_runs(parts: int, limit: int):
    def message(block: Block, got):
        runs = Runs(block)
        keys, counts = _surroundings(runs)
        known = {"key": [], "hot": []}
        for x in got:
            table = unpack(x)
            for name, found in known.items():
                found.append(table.column(name).to_numpy())
        shared = np.concatenate([*known["key"], np.zeros(0, np.uint64)])
        hot = np.concatenate([*known["hot"], np.zeros(0, bool)])
        hot = np.union1d(shared[hot], keys[counts > limit])
        first, later = _first_of_each(runs.content ^ mix(runs.key.copy()))
        if len(later):  # repeats inside the block need no exchange
            yield block.number % parts, pack(marked=runs.start[later].astype(np.int32),
                                             size=runs.size[later].astype(np.int32))
        some = first[np.isin(runs.key[first], np.concatenate([shared, keys[counts > 1]]))]
        split = np.isin(runs.key[some], hot)
        ids, singles, some = block.order, some[split], some[~split]
        for part, own in split_by_part(runs.key[some], parts):
            r = some[own]
            doc = runs.doc[r]
            yield part, pack(key=runs.key[r], id=ids[doc],
                             at=(runs.start[r] - block.starts[doc]).astype(np.int32),
                             place=runs.start[r].astype(np.int32),
                             size=runs.size[r].astype(np.int32),
                             text=_segments(block, runs.start[r], runs.size[r]))
        if not len(singles):
            return
        size = runs.size[singles]
        place = np.repeat(runs.start[singles] - np.cumsum(size) + size, size) + np.arange(size.sum())
        doc = np.repeat(runs.doc[singles], size)
        window = runs.window[place]
        first, later = _first_of_each(window)
        if len(later):
            yield block.number % parts, pack(marked=place[later].astype(np.int32),
                                             size=np.ones(len(later), np.int32))
        for part, own in split_by_part(window[first], parts):
            w = first[own]
            yield part, pack(window=window[w], id=ids[doc[w]],
                             at=(place[w] - block.starts[doc[w]]).astype(np.int32),
                             place=place[w].astype(np.int32))

    return message


def _spans(places: np.ndarray, sizes: np.ndarray | None = None) -> bytes:
    """Marked windows as runs of neighbours."""
    if sizes is not None:
        return pack(marked=places.astype(np.int32), size=sizes.astype(np.int32))
    places = np.sort(places)
    new = np.flatnonzero(np.concatenate([[True], np.diff(places) != 1]))
    return pack(marked=places[new].astype(np.int32),
                size=np.diff(new, append=len(places)).astype(np.int32))


def _later(group, doc_id, at, own) -> np.ndarray:
    """Indices of all but the earliest row of each group."""
    order = np.lexsort((own, at, doc_id, group))
    return order[1:][group[order][1:] == group[order][:-1]]


def _equal_windows(texts: list[bytes], sizes: np.ndarray):
    """(segment, offset, group) of the windows of distinct segments that are
    equal to another one, by suffix array and adjacent common prefixes."""
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    text = b"".join(texts)
    wanted = np.zeros(len(text), bool)
    wanted[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())] = True
    order = suffix_array(text, wanted, WINDOW)
    equal = adjacent_prefixes(text, order, WINDOW) >= WINDOW
    group = np.cumsum(~equal)
    some = equal | np.concatenate([equal[1:], [False]])
    order, group = order[some], group[some]
    segment = np.searchsorted(starts, order, side="right") - 1
    return segment, order - starts[segment], group


def _sort_part(blocks, payloads):
    """Windows that also start earlier, back to their blocks."""
    runs, singles = [], []
    for block, payload in zip(blocks, payloads):
        names = unpack(payload).column_names
        if "marked" in names:
            yield block, payload
        else:
            (runs if "key" in names else singles).append((block, payload))
    if singles:
        own = np.array([b for b, _ in singles])
        window, doc_id, at, place, owner = joined([p for _, p in singles],
                                                  "window", "id", "at", "place")
        late = _later(window, doc_id, at, own[owner])
        yield from answer_per_block(own.tolist(), owner[late], lambda i: _spans(place[late[i]]))
    if not runs:
        return
    own = np.array([b for b, _ in runs])
    key, doc_id, at, place, size, owner = joined([p for _, p in runs], "key", "id", "at",
                                                 "place", "size")
    texts = [t for _, p in runs for t in unpack(p).column("text").to_pylist()]
    order = np.lexsort((own[owner], at, doc_id, key))  # by anchor, then by place
    bounds = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1], [True]]))
    marked, marked_size, marked_owner = [], [], []
    batch, batch_bytes = [], 0

    def sort_batch():
        sizes = size[batch]
        segment, offset, group = _equal_windows([texts[r] for r in batch], sizes)
        row = np.array(batch)[segment]
        late = _later(group, doc_id[row], at[row] + offset, own[owner[row]])
        marked.append(place[row[late]] + offset[late])
        marked_size.append(np.ones(len(late), np.int64))
        marked_owner.append(owner[row[late]])

    whole = []  # runs whose content was seen in an earlier place
    for a, b in zip(bounds[:-1], bounds[1:]):
        seen, distinct = set(), []
        for r in order[a:b].tolist():
            if texts[r] in seen:
                whole.append(r)
            else:
                seen.add(texts[r])
                distinct.append(r)
        if len(distinct) > 1:
            batch += distinct
            batch_bytes += sum(len(texts[r]) for r in distinct)
        if batch_bytes >= SORT_BYTES:
            sort_batch()
            batch, batch_bytes = [], 0
    if batch:
        sort_batch()
    whole = np.array(whole, np.int64)
    if len(whole):
        yield from answer_per_block(own.tolist(), owner[whole],
                                    lambda i: _spans(place[whole[i]], size[whole[i]]))
    if marked:
        at_place, by = np.concatenate(marked), np.concatenate(marked_owner)
        yield from answer_per_block(own.tolist(), by, lambda i: _spans(at_place[i]))


def _removed(block: Block, got) -> np.ndarray:
    """Mask of the bytes that marked windows cover."""
    change = np.zeros(len(block.data) + WINDOW, np.int32)
    for x in got:
        table = unpack(x)
        start = table.column("marked").to_numpy().astype(np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + table.column("size").to_numpy() + WINDOW - 1, -1)
    return np.cumsum(change[:len(block.data)]) > 0


def _rows(block: Block, got) -> pa.RecordBatch:
    gone = _removed(block, got)
    keep = ~gone
    keep[block.ends] = False  # the separators
    rises = gone & ~np.concatenate([[False], gone[:-1]])
    total = np.concatenate([[0], np.cumsum(gone)])
    spans = np.concatenate([[0], np.cumsum(rises)])
    kept = [block.data[a:b][keep[a:b]].tobytes() for a, b in zip(block.starts, block.ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block.ids, pa.int64()),
         *(pa.array(x, pa.int64()) for x in (block.ends - block.starts,
                                             total[block.ends] - total[block.starts],
                                             spans[block.ends] - spans[block.starts])),
         pa.array([hashlib.sha256(t).hexdigest() for t in kept]), pa.array(kept, pa.binary())],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def _digests(block: Block, got) -> pa.RecordBatch:
    return _rows(block, got).select(["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, with_text: bool = False,
                 block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the
    kept bytes themselves on demand."""
    blocks = write_blocks(docs, block_bytes=block_bytes)
    parts = blocks.parts
    shared = blocks.exchange(blocks.send(_send_anchors(parts)), _shared_anchors(hot))
    marked = blocks.exchange(blocks.send(_send_runs(parts, hot), shared), _sort_part)
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    if with_text:
        return blocks.finish(_rows, schema + ", kept_text binary", marked)
    return blocks.finish(_digests, schema, marked)
