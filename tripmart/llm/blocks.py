"""Documents in blocks, and exchanges of packed arrays between them.

Several operators look for the same passage in different documents. They
share this layout: documents are written once, in blocks of about a megabyte
with compressed texts, to a table bucketed by block. A step then sends packed
arrays from blocks to ``part`` numbers (a hash of the key), works on each
part in numpy, and sends packed answers back to the blocks, which are joined
to the bucketed table without moving any text.

A key is sent once per block, however often the block holds it, so a key that
a third of all documents share is one entry per block.
"""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.shipping import ship_package
from tripmart.session import scratch_path

#: Text per block; a longer text is a block by itself.
BLOCK_BYTES = 1 << 20
#: Text per bucket and per part of an exchange.
BUCKET_BYTES = 24 << 20
MESSAGE = "part int, block long, payload binary"
ANSWER = "block long, payload binary"

# --- packed arrays -----------------------------------------------------------


def pack(**columns) -> bytes:
    """Columns of equal length as one compressed Arrow stream."""
    table = pa.table({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(payload) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def give_back() -> None:
    """Hand freed memory back to the system: a worker lives on for other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def batch(schema: str, *columns) -> pa.RecordBatch:
    """A record batch of one of the schemas here, from lists."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in
                                       zip(columns, fields)], [n for n, _ in fields])


# --- blocks ------------------------------------------------------------------


@dataclass
class Block:
    """Documents in storage order of doc_id (NULL first), as bytes that are
    separated by one space."""

    number: int
    ids: list[int | None]
    data: np.ndarray  # uint8
    starts: np.ndarray
    ends: np.ndarray

    @property
    def order(self) -> np.ndarray:
        """doc_id as int64; NULL is the smallest."""
        low = np.iinfo(np.int64).min
        return np.array([low if i is None else i for i in self.ids], np.int64)

    def only(self, docs: list[int]) -> "Block":
        """A block of some of the documents."""
        sizes = (self.ends - self.starts)[docs] if docs else np.zeros(0, np.int64)
        ends = np.cumsum(sizes + 1) - 1
        data = [self.data[self.starts[d]:self.ends[d] + 1] for d in docs]
        return Block(self.number, [self.ids[d] for d in docs],
                     np.concatenate([*data, np.zeros(0, np.uint8)]), ends - sizes, ends)


def _open_block(number: int, payload) -> Block:
    table = unpack(payload)
    text = table.column("text").combine_chunks()
    text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] \
        if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    data = np.full(len(raw) + len(sizes), 32, np.uint8)
    gap = np.zeros(len(data), bool)
    gap[ends] = True
    data[~gap] = raw
    return Block(number, table.column("doc_id").to_pylist(), data, starts, ends)


def _cut_blocks(batches, block_bytes: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    ids, texts, size = [], [], 0

    def close():
        nonlocal number, ids, texts, size
        by_id = sorted(range(len(ids)), key=lambda k: (ids[k] is not None, ids[k] or 0))
        payload = pack(doc_id=pa.array([ids[k] for k in by_id], pa.int64()),
                       text=pa.array([texts[k] for k in by_id], pa.large_binary()))
        out = batch(ANSWER, [number], [payload])
        number, ids, texts, size = number + 1, [], [], 0
        return out

    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids.append(i)
            texts.append(text or b"")
            size += len(text or b"")
            if size >= block_bytes:
                yield close()
    if ids:
        yield close()


@dataclass
class Blocks:
    table: DataFrame  # block long, payload binary; bucketed by block
    parts: int

    @property
    def spark(self) -> SparkSession:
        return self.table.sparkSession

    def send(self, message: Callable, *answers: DataFrame) -> DataFrame:
        """Run ``message(block, *answers to it)`` on every block; it yields (part,
        payload)."""
        def rows(block, *got):
            found = [(p, block.number, x) for p, x in message(block, *got)]
            return batch(MESSAGE, *zip(*found)) if found else None

        return self.finish(rows, MESSAGE, *answers)

    def finish(self, rows: Callable, schema: str, *answers: DataFrame) -> DataFrame:
        """Run ``rows(block, *answers to it)`` on every block; it returns a record
        batch. Answers are frames of (block, payload); a block gets a list from each."""
        def run(batches):
            for b in batches:
                for k in range(b.num_rows):
                    got = [b.column(c)[k].as_py() or [] for c in range(2, b.num_columns)]
                    block = _open_block(b.column(0)[k].as_py(), b.column(1)[k].as_buffer())
                    out = rows(block, *got)
                    if out is not None:
                        yield out
            give_back()

        table = self.table
        for k, answer in enumerate(answers):
            collected = answer.groupBy("block").agg(F.collect_list("payload").alias(f"got{k}"))
            table = table.join(collected.hint("merge"), "block", "left")
        return table.mapInArrow(run, schema)

    def exchange(self, messages: DataFrame, work: Callable, schema: str = ANSWER) -> DataFrame:
        """Bring messages together by part; ``work(blocks, payloads)`` sees all of
        a part (or of a few parts) and yields (block, payload) answers."""

        def run(batches):
            blocks, payloads = [], []
            for b in batches:
                blocks += b.column(1).to_pylist()
                payloads += b.column(2).to_pylist()
            if blocks:
                rows = list(work(blocks, payloads))
                if rows:
                    yield batch(schema, *zip(*rows))
            give_back()

        # by the part number itself, so that no task gets several parts
        return messages.repartitionById(self.parts, F.col("part")).mapInArrow(run, schema)


def write_blocks(docs: DataFrame, text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Write ``doc_id`` and the text's UTF-8 bytes (NULL: empty) as blocks."""
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col(text_col).cast("binary").alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(8, -(-size // BUCKET_BYTES))
    name = f"blocks_{uuid.uuid4().hex}"
    (narrow.mapInArrow(lambda batches: _cut_blocks(batches, block_bytes), ANSWER).write.bucketBy(parts, "block").sortBy("block")
           .option("path", scratch_path(spark, f"tables/{name}"))
           .option("compression", "none").saveAsTable(name))
    return Blocks(spark.table(name), parts)


# --- hashes ------------------------------------------------------------------

# Odd 64-bit multipliers.
_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                             0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _M[0]) ^ (np.arange(1, 257, dtype=np.uint64)[::-1]
                                                        * _M[2] >> np.uint64(7))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of every number, in place, a cache-sized piece at a time."""
    for k in range(0, len(x), 1 << 15):
        part = x[k:k + (1 << 15)]
        part ^= part >> np.uint64(31)
        part *= _M[1]
        part ^= part >> np.uint64(29)
        part *= _M[3]
        part ^= part >> np.uint64(32)
    return x


def window_hashes(base: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Hash of ``base[i:i + n]`` at every i where it fits, for each n, built
    from windows of powers of two."""
    powers = {1: base}
    top = 1
    while 2 * top <= max(lengths):
        a = powers[top]
        n = max(0, len(a) - top)
        powers[2 * top] = mix(a[:n] * _M[top.bit_length() % 4 + 2] + a[len(a) - n:])
        top *= 2
    out = []
    for length in lengths:
        size = max(0, len(base) - length + 1)
        at, h = 0, None
        for p in sorted((p for p in powers if length & p), reverse=True):
            piece = powers[p][at:at + size]
            h = piece.copy() if h is None else mix(h * _M[5] + piece)
            at += p
        out.append(h if h is not None else np.zeros(size, np.uint64))
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RATIO = int(_M[4]) | 3  # odd, so that it has an inverse modulo 2^64
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """The powers 0..n-1 of the ratio and of its inverse; a worker keeps them."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
        for k, factor in enumerate((_RATIO, pow(_RATIO, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of byte codes times powers of their place, and the inverse powers: a
    difference of two sums, times the inverse at its start, depends only on the
    bytes between."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], dtype=np.uint64, out=sums[1:])
    return sums, inverse


def byte_window_hashes(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Hash of ``data[i:i + n]`` at every i where it fits, for each n."""
    sums, inverse = _prefix_sums(data)
    out = []
    for n in lengths:
        size = max(0, len(data) - n + 1)
        h = sums[n:n + size] - sums[:size]
        h *= inverse[:size]
        out.append(mix(h))
    return out


@dataclass
class Words:
    """Maximal runs of other bytes than [\x20\x09-\x0D], with their hashes."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # of each document, its first word; one more at the end
    code: np.ndarray


def words_of(block: Block, data: np.ndarray | None = None) -> Words:
    data = block.data if data is None else data
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    first = np.searchsorted(start, np.append(block.starts, len(data) + 1))
    doc = np.repeat(np.arange(len(block.ids)), np.diff(first))
    if not len(start):
        return Words(start, end, doc, first, np.zeros(0, np.uint64))
    return Words(start, end, doc, first, _word_codes(data, start, end))


#: Bytes of a word that are hashed eight at a time; longer ones go to BLAKE2.
_LONG_WORD = 1024
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes: eight bytes at a time enter a state that is
    mixed after each step, so equal states need equal bytes before."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    code = mix((size.astype(np.uint64) + np.uint64(1)) * _M[2])
    live = np.arange(len(size))
    for k in range(0, _LONG_WORD, 8):
        live = live[(size[live] > k) & (size[live] <= _LONG_WORD)]
        if not len(live):
            break
        x = eight[start[live] + k] & _TAIL[np.minimum(size[live] - k, 8)]
        code[live] = mix((code[live] ^ x) * _M[0] + _M[4])
    for w in np.flatnonzero(size > _LONG_WORD):
        digest = hashlib.blake2b(data[start[w]:end[w]].tobytes(), digest_size=8).digest()
        code[w] = np.frombuffer(digest, "<u8")[0]
    return code


def split_by_part(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, indices of the keys that belong to it)."""
    part = ((keys >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(bounds)):
        yield int(p), order[bounds[p]:bounds[p + 1]]


def joined(payloads, *names: str) -> tuple[np.ndarray, ...]:
    """Column arrays over several payloads, then the payload number of each row."""
    tables = [unpack(p) for p in payloads]
    columns = [np.concatenate([t.column(n).to_numpy() for t in tables]) for n in names]
    return (*columns, np.repeat(np.arange(len(tables)), [t.num_rows for t in tables]))
