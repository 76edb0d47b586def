"""Byte-level BPE encoding and decoding with a segment tree.

A piece (one match of the split pattern) starts as single bytes. A segment
tree over byte positions holds, for every live symbol, the rank of the pair
it makes with its right neighbour; each inner node holds the smallest rank of
its range, leftmost on ties. A merge takes the root's minimum and updates the
leaves of the merged symbol, of the one it swallowed and of its left
neighbour, so a piece of n bytes takes O(n log n), whatever its length. The
trees of many pieces stand side by side in one array.

Defined results: a NULL or empty text has no tokens; special tokens are
ordinary text; ``decode`` gives back the bytes that were encoded.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.blocks import give_back
from tripmart.llm.shipping import ship_package

#: Pieces, and stretches of text, whose tokens a worker remembers.
CACHE_PIECES = 200_000
CACHE_STRETCHES = 400_000
#: The same for tokenize(), which shares its executor with what a pipeline left.
SMALL_PIECES = 50_000
SMALL_STRETCHES = 200_000
#: Longer ones are rare, and are encoded anew each time.
CACHE_BYTES = 64
#: Characters whose unknown pieces are merged together.
LEARN_CHARS = 1 << 18
#: Leaves of the segment trees that are built side by side.
LEAVES = 1 << 19
#: Rows, and bytes of text, that tokenize() encodes and sends back at a time (a
#: longer text goes by itself).
SLICE_ROWS = 500
SLICE_BYTES = 1 << 20


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """The lines of a rank file: base64 token, space, rank."""
    ranks = {}
    for line in data.splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


class PairRanks:
    """Ranks of neighbouring tokens, as sorted keys (left id, right id)."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(keys)
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.values = np.append(np.array(values, np.int64)[order], -1)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        # one object per id, shared by all that is remembered
        self.ids = np.empty(max(ranks.values(), default=0) + 1, object)
        self.ids[:] = range(len(self.ids))

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged pair, -1 if it has none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)


def merge_pieces(pieces: list[bytes], pairs: PairRanks) -> list[tuple[int, ...]]:
    """Token ids of each piece: its leftmost pair of lowest rank is merged until
    no neighbours have a rank. Pieces of about one length are worked on side by
    side, each with its own segment tree, a merge of every piece at a time."""
    out: list[tuple[int, ...]] = [()] * len(pieces)
    groups: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        groups.setdefault(max(1, (len(piece) - 1).bit_length()), []).append(k)
    for bits, members in groups.items():
        step = max(1, LEAVES >> bits)  # bounds the arrays
        for at in range(0, len(members), step):
            some = members[at:at + step]
            for k, ids in zip(some, _merge_side_by_side([pieces[k] for k in some], bits, pairs)):
                out[k] = ids
    return out


def _merge_side_by_side(pieces: list[bytes], bits: int, pairs: PairRanks):
    leaves = 1 << bits
    rows = len(pieces)
    size = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8)
    symbol = pairs.bytes[text].reshape(rows, leaves)
    place = np.arange(leaves)
    inside = place < size[:, None]
    after = np.tile(place + 1, (rows, 1))  # start of the symbol to the right
    before = np.tile(place - 1, (rows, 1))
    live = inside.copy()
    # A node holds rank << bits | place: the smallest is the leftmost lowest.
    wide = np.int64 if bits > 14 else np.int32
    none = np.iinfo(wide).max
    tree = np.full((rows, 2 * leaves), none, wide)
    both = inside[:, 1:]
    rank = np.full(both.shape, -1)
    rank[both] = pairs.find(symbol[:, :-1][both], symbol[:, 1:][both])
    tree[:, leaves:2 * leaves - 1] = np.where(rank >= 0, rank << bits | place[:-1], none)
    for level in range(bits - 1, -1, -1):
        low, high = 1 << level, 2 << level
        tree[:, low:high] = np.minimum(tree[:, 2 * low:2 * high:2], tree[:, 2 * low + 1:2 * high:2])
    flat, flat_symbol = tree.reshape(-1), symbol.reshape(-1)
    flat_after, flat_before, flat_live = after.reshape(-1), before.reshape(-1), live.reshape(-1)

    def pair_value(left, right, at):
        found = pairs.find(left, right)
        return np.where(found >= 0, found << bits | at, none)

    row = np.flatnonzero(tree[:, 1] != none)
    while len(row):
        base, root = row * leaves, row * 2 * leaves
        lowest = flat[root + 1].astype(np.int64)
        i, merged = lowest & (leaves - 1), lowest >> bits
        j = flat_after[base + i]
        e = flat_after[base + j]
        left = flat_before[base + i]
        flat_symbol[base + i] = merged
        flat_after[base + i] = e
        flat_live[base + j] = False
        more, has_left = e < size[row], left >= 0
        flat_before[(base + e)[more]] = i[more]
        value = np.full(len(row), none, np.int64)
        value[more] = pair_value(merged[more], flat_symbol[(base + e)[more]], i[more])
        flat[root + leaves + j] = none
        flat[root + leaves + i] = value
        value = pair_value(flat_symbol[(base + left)[has_left]], merged[has_left], left[has_left])
        flat[(root + leaves + left)[has_left]] = value
        # the three changed leaves, level by level up to the root
        nodes = [(root, leaves + i), (root, leaves + j), (root[has_left], (leaves + left)[has_left])]
        for _ in range(bits):
            nodes = [(r, k >> 1) for r, k in nodes]
            for r, k in nodes:
                flat[r + k] = np.minimum(flat[r + 2 * k], flat[r + 2 * k + 1])
        row = row[flat[root + 1] != none]
    ids = pairs.ids[symbol[live]].tolist()
    end = np.cumsum(live.sum(1)).tolist()
    return [tuple(ids[a:b]) for a, b in zip([0, *end], end)]


class Memory:
    """What was encoded lately: a full generation becomes the old one, and what
    is still asked for moves on to the new one."""

    def __init__(self, size: int):
        self.size = size
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def old_or_none(self, key: str):
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key: str, value: tuple[int, ...]) -> None:
        if len(self.new) >= self.size:
            self.old = dict(self.new)
            self.new.clear()  # the same object, so that its bound get() stays valid
        self.new[key] = value


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str,
                 sizes: tuple[int, int] = (CACHE_PIECES, CACHE_STRETCHES)):
        self.ranks, self.sizes = ranks, sizes
        self.split = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in ranks.values()}
        self.pairs = PairRanks(ranks)
        self.forget()

    def forget(self) -> None:
        """Give back what is remembered; it is learned anew as needed."""
        self.pieces, self.stretches = map(Memory, self.sizes)

    def _ids(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each piece; those that are new are merged all at once."""
        got, new = {}, []
        for x in pieces:
            memory, key = self._place(x)
            ids = memory.new.get(key) or memory.old_or_none(key)
            if ids is None:
                data = x.encode("utf-8", "replace")
                own = self.ranks.get(data)
                if own is None:
                    new.append((x, data))
                    continue
                ids = (self.pairs.ids[own],)
            got[x] = ids
        for (x, data), ids in zip(new, merge_pieces([d for _, d in new], self.pairs)):
            got[x] = ids
            if len(data) <= CACHE_BYTES:
                memory, key = self._place(x)
                memory.put(key, ids)
        return got

    def _place(self, piece: str) -> tuple[Memory, str]:
        """Where a piece is remembered: a word after a space is a stretch too, and
        is remembered once for both."""
        if piece[0] == " " and " " not in piece[1:] and not piece[-1].isspace():
            return self.stretches, piece[1:]
        return self.pieces, piece

    def _stretches(self, text: str, missing: dict[str, list]) -> list:
        """The ids of each stretch of a text, in order. A stretch that isn't
        known is left open: ``missing`` gets its place.

        No piece goes on over a space that follows another character than white
        space, and none looks behind: a text may be cut before such spaces.
        """
        out: list = []
        known, add = self.stretches.new.get, out.append
        first, *rest = text.split(" ")
        waiting = None
        if first and first[-1].isspace():
            waiting = first
        elif first:
            missing.setdefault(first, []).append((out, 0))
            add(None)
        for part in rest:
            if waiting is None:
                found = known(part)
                if found is None:
                    if not part or part[-1].isspace():
                        waiting = " " + part
                        continue
                    found = self.stretches.old_or_none(part)
                    if found is None:
                        missing.setdefault(" " + part, []).append((out, len(out)))
                add(found)
            else:
                waiting += " " + part
                if part and not part[-1].isspace():
                    missing.setdefault(waiting, []).append((out, len(out)))
                    add(None)
                    waiting = None
        if waiting is not None:
            missing.setdefault(waiting, []).append((out, len(out)))
            add(None)
        return out

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str | None]):
        """The ids of each text, in order."""
        start, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text or "")
            if size >= LEARN_CHARS or k == len(texts) - 1:
                missing: dict[str, list] = {}
                plans = [self._stretches(t or "", missing) for t in texts[start:k + 1]]
                split = {x: self.split(x) for x in missing}
                got = self._ids({p for pieces in split.values() for p in pieces})
                for x, pieces in split.items():
                    ids = (got[pieces[0]] if len(pieces) == 1 else
                           tuple(chain.from_iterable(map(got.__getitem__, pieces))))
                    for plan, at in missing[x]:
                        plan[at] = ids
                    # as after " ": the key of a stretch is what follows its space
                    if x[0] == " " and 1 < len(x) <= CACHE_BYTES and not x[-1].isspace() \
                            and " " not in x[1:]:
                        self.stretches.put(x[1:], ids)
                for plan in plans:
                    yield list(chain.from_iterable(plan))
                start, size = k + 1, 0

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decimal(self, ids) -> bytes:
        return ",".join(map(self.names.__getitem__, ids)).encode()


@contextmanager
def _no_collector():
    """Nothing here makes reference cycles; walking what a worker remembers in
    search of some took a quarter of its time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_encoders: dict[tuple, ByteBpe] = {}


def _encoder(shared, sizes: tuple[int, int] = (CACHE_PIECES, CACHE_STRETCHES)) -> ByteBpe:
    """One encoder per worker and vocabulary: its memory lasts over batches."""
    data, pattern = shared.value
    key = (hash(data), pattern, sizes)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ByteBpe(parse_ranks(data), pattern, sizes)
    return _encoders[key]


def share_vocabulary(spark: SparkSession, path: str, pattern: str):
    """Broadcast a rank file (its size is fixed by the vocabulary)."""
    ship_package(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast((f.read(), pattern))


def encoder(shared):
    """Column function: text -> array of token ids."""

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        bpe = _encoder(shared)
        with _no_collector():
            return pd.Series(list(bpe.encode_all(texts.where(texts.notna(), None).tolist())))

    return encode


def decoder(shared):
    """Column function: array of token ids -> bytes."""

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        bpe = _encoder(shared)
        return pd.Series([bpe.decode([] if x is None else list(x)) for x in ids])

    return decode


def tokenize(docs: DataFrame, shared, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of each row, its token ids and the fields of
    round_trip(). Rows go back a slice at a time, so what a task holds does not
    grow with its batches."""
    kept = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType(kept.fields + [
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        give_back()  # what earlier work of this worker has freed
        bpe = _encoder(shared, (SMALL_PIECES, SMALL_STRETCHES))
        for batch in batches:
            for start, rows in _slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(start, rows)
                texts = part.column(part.num_columns - 1).to_pylist()
                with _no_collector():
                    ids = list(bpe.encode_all(texts))
                    digests = list(zip(*[_digests(bpe, x) for x in ids]))
                flat = np.fromiter(chain.from_iterable(ids), np.int32)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(ends, flat),
                     *map(pa.array, digests)], [f.name for f in schema.fields])
        # in a pipeline the worker goes on to other work
        bpe.forget()
        give_back()

    return docs.select(*[docs[c] for c in keep], docs[text_col]).mapInArrow(run, schema)


def _slices(texts: pa.Array):
    """(start, rows) of stretches of at most SLICE_ROWS texts and, if it has more
    than one text, SLICE_BYTES."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False),
                     dtype=np.int64)
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, done + SLICE_BYTES, "right"))
        stop = max(start + 1, min(stop, start + SLICE_ROWS))
        yield start, stop - start
        start = stop


def _digests(bpe: ByteBpe, ids: list[int]) -> tuple[int, str, str]:
    return (len(ids), hashlib.sha256(bpe.decimal(ids)).hexdigest(),
            hashlib.sha256(bpe.decode(ids)).hexdigest())


def round_trip(shared):
    """Column function: text -> number and digest of its ids, and digest of the
    bytes that the ids decode to; no ids leave the worker."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        bpe = _encoder(shared)
        with _no_collector():
            rows = [_digests(bpe, ids) for ids in
                    bpe.encode_all(texts.where(texts.notna(), None).tolist())]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests
