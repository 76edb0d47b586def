"""Spelling variants: exact neighbours of words by a trie-node pair dictionary.

A word of m letters passes m + 1 nodes of a forward trie (its beginnings) and
m + 1 of a reversed trie (its endings). Tasks number nodes alike without
sharing a trie: a node's number is a 64-bit fingerprint of the path to it,
built letter by letter. The dictionary holds, per word,

* its splits (prefix node of the first i letters, suffix node of the rest),
* its skips (prefix node of the first i letters, suffix node after letter i).

Two words with a skip in common differ by one replaced letter; a skip of one
word that is a split of another is one inserted or deleted letter (skips count
here at the last of a run of equal letters only, so a pair is found once).
Pairs are found by sorting the integer pairs; a pair of integers has at most
one word per letter of the alphabet, so no group is large. Found pairs are
compared letter by letter, so equal fingerprints of different paths can't
make a wrong neighbour.

A word's form is its neighbour with the largest count, if that is at least
``RATIO`` times its own; forms are followed to a root by pointer doubling
(counts grow by the factor each time, so chains are short).

Defined results: a NULL text has no words; a NULL doc_id counts as empty text
in the crc32. Rows that share a doc_id are counted each. An empty table gives
no rows. A word has no length limit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.shipping import ship_package
from tripmart.session import cut_lineage

#: Letters of a word, occurrences over all documents, and how much more
#: frequent a form must be.
LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
#: A run loses a letter where this divides its crc32.
NOISE = 199
_SLICE = 4 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ASCII = np.zeros(256, bool)
_ASCII[list(range(65, 91)) + list(range(97, 123))] = True
_LEAD = 0xC3  # UTF-8 of U+00C0 to U+00FF: this byte and one more

# --- counting ----------------------------------------------------------------


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320),
                         table >> np.uint32(1))
    return table


_CRC = _crc_table()


def _run_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray,
              seed: np.ndarray) -> np.ndarray:
    """crc32 of every run, carried on from the seed (a crc32 itself)."""
    size = end - start
    crc = ~seed
    order = np.argsort(-size, kind="stable")
    rank = size[order]
    for k in range(min(64, int(rank[0]) if len(rank) else 0)):
        live = order[:np.searchsorted(-rank, -k)]
        c = crc[live]
        crc[live] = _CRC[(c ^ data[start[live] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    crc = ~crc
    for k in order[:np.searchsorted(-rank, -64)]:  # long runs, one by one
        crc[k] = zlib.crc32(data[start[k]:end[k]].tobytes(), int(seed[k]))
    return crc


def _count_slice(data: np.ndarray, first: np.ndarray, seeds: np.ndarray) -> pa.RecordBatch:
    """(word, n) of the runs of lower-cased texts that lie end to end in
    ``data`` with a space after each; ``first``: where each begins."""
    lead = data == _LEAD
    letter = _ASCII[data] | lead
    letter[1:] |= lead[:-1]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    twos = np.concatenate([[0], np.cumsum(lead)])
    letters = end - start - (twos[end] - twos[start])
    long = letters >= LEAST_LETTERS
    start, end, letters = start[long], end[long], letters[long]
    crc = _run_crcs(data, start, end, seeds[np.searchsorted(first, start, "right") - 1])
    hit = crc % np.uint32(NOISE) == 0
    changed = []
    for k in np.flatnonzero(hit):
        word = data[start[k]:end[k]].tobytes().decode()
        at = int(crc[k]) % len(word)
        if len(word) > LEAST_LETTERS:
            changed.append(word[:at] + word[at + 1:])
    start, end = start[~hit], end[~hit]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] = 1
    inside[end] -= 1
    body = data[np.cumsum(inside[:-1]) > 0]
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    kept = pa.Array.from_buffers(pa.large_string(), len(start),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    both = pa.concat_arrays([kept, pa.array(changed, pa.large_string())])
    counts = pc.value_counts(both)
    return pa.RecordBatch.from_arrays([counts.field("values").cast(pa.string()),
                                       counts.field("counts")], ["word", "n"])


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about a slice that end between words."""
    start = 0
    while start < len(text):
        end = min(start + _SLICE, len(text))
        while end < len(text) and (_ASCII[text[end]] or text[end] >= 128):
            end += 1
        yield text[start:end]
        start = end


def _count(batches) -> Iterator[pa.RecordBatch]:
    """Partial counts: a row per distinct word of a slice."""
    texts, first, seeds, size = [], [], [], 0

    def close():
        data = np.frombuffer(b"".join(texts), np.uint8)
        return _count_slice(data, np.array(first, np.int64), np.array(seeds, np.uint32))

    for b in batches:
        for name, text in zip(b.column(0).to_pylist(), b.column(1)):
            seed = zlib.crc32((name or "").encode() + b":")
            for piece in _pieces(text.as_py() or b""):
                texts.append(piece.translate(_LOWER) + b" ")
                first.append(size)
                seeds.append(seed)
                size += len(piece) + 1
                if size >= _SLICE:
                    yield close()
                    texts, first, seeds, size = [], [], [], 0
    if texts:
        yield close()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with enough letters and occurrences."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.col(text_col).cast("binary").alias("text"))
    return (rows.mapInArrow(_count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT))


# --- the pair dictionary -------------------------------------------------------

# Odd 64-bit multipliers, one per trie.
_FORWARD, _REVERSED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PAIR = "prefix long, suffix long, is_split boolean, can_drop boolean, wid long, at int"


def _step(node: np.ndarray, letter: np.ndarray, factor: np.uint64) -> np.ndarray:
    """The number of each node's child along a letter."""
    h = (node ^ letter.astype(np.uint64)) * factor
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(29))


def _node_paths(codes: np.ndarray, first: np.ndarray, size: np.ndarray,
                factor: np.uint64, backwards: bool) -> np.ndarray:
    """Numbers of all nodes on the words' paths: word w's are at
    ``first[w] + w`` and on, one more than it has letters, the root at the
    beginning (at the end, if backwards)."""
    nodes = np.full(len(codes) + len(first), factor, np.uint64)
    order = np.argsort(-size, kind="stable")
    rank = size[order]
    base = first + np.arange(len(first))
    for k in range(int(rank[0]) if len(rank) else 0):
        live = order[:np.searchsorted(-rank, -k)]  # words with more than k letters
        if backwards:
            at = size[live] - 1 - k
            nodes[base[live] + at] = _step(nodes[base[live] + at + 1], codes[first[live] + at],
                                           factor)
        else:
            nodes[base[live] + k + 1] = _step(nodes[base[live] + k], codes[first[live] + k],
                                              factor)
    return nodes


def _dictionary(batches) -> Iterator[pa.RecordBatch]:
    """All splits and skips of the words (wid, word)."""
    for b in batches:
        for part in _some_letters(b):
            wid = np.asarray(part.column(0), np.int64)
            words = part.column(1).to_pylist()
            size = np.array([len(w) for w in words], np.int64)
            first = np.cumsum(size) - size
            codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
            prefix = _node_paths(codes, first, size, _FORWARD, False)
            suffix = _node_paths(codes, first, size, _REVERSED, True)
            owner = np.repeat(np.arange(len(words)), size + 1)
            at = np.arange(len(prefix)) - (first + np.arange(len(words)))[owner]
            skip = np.flatnonzero(at < size[owner])
            # a letter equal to the next one isn't dropped: the next one is
            here = first[owner[skip]] + at[skip]
            last = at[skip] + 1 == size[owner[skip]]
            drop = last | (codes[here] != codes[np.minimum(here + 1, len(codes) - 1)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([prefix, prefix[skip]]).view(np.int64)),
                 pa.array(np.concatenate([suffix, suffix[skip + 1]]).view(np.int64)),
                 pa.array(np.repeat([True, False], [len(prefix), len(skip)])),
                 pa.array(np.concatenate([np.zeros(len(prefix), bool), drop])),
                 pa.array(np.concatenate([wid[owner], wid[owner[skip]]])),
                 pa.array(np.concatenate([at, at[skip]]).astype(np.int32))],
                [f.split()[0] for f in PAIR.split(", ")])


def _some_letters(b: pa.RecordBatch, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in parts of so many bytes of words, one row at least."""
    sizes = pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // most
    bounds = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for lo, hi in zip(bounds, bounds[1:]):
        yield b.slice(lo, hi - lo)


def _meet(batches) -> Iterator[pa.RecordBatch]:
    """Pairs of words that share an integer pair, from rows sorted by it. What
    is carried between batches is one group."""
    rest = None
    for b in batches:
        t = [b.column(k).to_numpy(zero_copy_only=False) for k in range(b.num_columns)]
        if rest is not None:
            t = [np.concatenate([x, y]) for x, y in zip(rest, t)]
        if not len(t[0]):
            continue
        same_as_last = (t[0] == t[0][-1]) & (t[1] == t[1][-1])
        cut = len(t[0]) - int(np.argmin(same_as_last[::-1])) if not same_as_last.all() else 0
        rest = [x[cut:] for x in t]
        yield from _pairs([x[:cut] for x in t])
    if rest is not None:
        yield from _pairs(rest)


def _pairs(t: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    prefix, suffix, split, drop, wid, at = t
    i = np.arange(len(wid))
    lag = 1
    while True:
        i = i[i + lag < len(wid)]
        i = i[(prefix[i] == prefix[i + lag]) & (suffix[i] == suffix[i + lag])]
        if not len(i):
            return
        j = i + lag
        both = ~split[i] & ~split[j]
        ok = (at[i] == at[j]) & (both | (split[i] & drop[j]) | (split[j] & drop[i]))
        a = np.where(split[i], j, i)[ok]  # of a skip and a split, the skip
        b = np.where(split[i], i, j)[ok]
        if len(a):
            yield pa.RecordBatch.from_arrays(
                [pa.array(wid[a]), pa.array(wid[b]), pa.array(at[a]), pa.array(both[ok])],
                ["a", "b", "at", "replaced"])
        lag += 1


def near_words(words: DataFrame) -> DataFrame:
    """(wid, near_wid, near_word, near_n): every ordered pair of rows of
    ``words`` (wid long, word, n) at one inserted, deleted or replaced letter."""
    ship_package(words.sparkSession)
    keys = words.select("wid", "word").mapInArrow(_dictionary, PAIR)
    keys = keys.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    found = keys.mapInArrow(_meet, "a long, b long, at int, replaced boolean")
    one = words.select(F.col("wid").alias("a"), F.col("word").alias("a_word"),
                       F.col("n").alias("a_n"))
    two = words.select(F.col("wid").alias("b"), F.col("word").alias("b_word"),
                       F.col("n").alias("b_n"))
    found = found.join(one, "a").join(two, "b")

    size = F.char_length("a_word")
    after = F.substr("a_word", F.col("at") + 2, size)
    rest = F.substr("b_word", F.col("at") + F.when(F.col("replaced"), 2).otherwise(1), size)
    found = cut_lineage(found.filter(
        (size == F.char_length("b_word") + F.when(F.col("replaced"), 0).otherwise(1))
        & (F.substr("a_word", F.lit(1), F.col("at")) == F.substr("b_word", F.lit(1), F.col("at")))
        & (after == rest)), "near_words")
    return found.select(F.col("a").alias("wid"), F.col("b").alias("near_wid"),
                        F.col("b_word").alias("near_word"), F.col("b_n").alias("near_n")).union(
        found.select("b", "a", "a_word", "a_n"))


def _roots(links: DataFrame) -> DataFrame:
    """(wid, root): the last row that ``links`` (wid, form_wid) lead to."""
    now = cut_lineage(links.select("wid", F.col("form_wid").alias("root")), "roots")
    while True:
        on = now.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        further = now.join(on, "root", "left")
        further = cut_lineage(further.select(
            "wid", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        now = further.select("wid", "root")
        if further.filter("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = cut_lineage(word_counts(docs, id_col, text_col).withColumn(
        "wid", F.monotonically_increasing_id()), "spelling_words")
    best = near_words(words).groupBy("wid").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near_word"),
                       F.col("near_wid"))).alias("best"))
    rows = words.join(best, "wid", "left")
    far = F.coalesce(-F.col("best.minus_n") >= F.col("n") * RATIO, F.lit(False))
    rows = cut_lineage(rows.select(
        "wid", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(far, F.col("best.near_word")).alias("form"),
        F.when(far, -F.col("best.minus_n")).alias("form_n"),
        F.when(far, F.col("best.near_wid")).alias("form_wid")), "spelling_forms")
    roots = _roots(rows.filter("form_wid IS NOT NULL").select("wid", "form_wid"))
    roots = roots.join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")),
                       "root").select("wid", "root_word")
    return rows.join(roots, "wid", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
