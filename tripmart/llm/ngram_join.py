"""N-gram Jaccard join: documents whose shingle sets are similar, exactly.

A document's set holds the 64-bit hashes of its distinct shingles, 4 words
long unless the caller says otherwise. Sets link when their Jaccard similarity
is ``percent`` or more (85 unless the caller says otherwise); the result is
each document's connected component.

1. Equal sets are one class, kept by its smallest doc_id.
2. Tokens are ordered: those of one class alone first, then by hash. Linked
   sets share a token of their prefixes (the first 15 % at 85, plus one), so a
   set with that many tokens of its own has no links, whatever passages or lines
   it shares. Index lists of the other prefix tokens are sorted by set size:
   from an entry, blocks of larger sets are skipped as soon as one is too
   large, entries by position when too few tokens are left, and entries by a
   512-bit parity sketch whose Hamming distance is never above the size of
   the symmetric difference. What is left joins candidates; pairs already in
   one group are skipped too, so lists give spanning edges, not pairs.
3. The groups of candidates are verified: each set goes to its group, in full;
   groups of over GROUP sets are cut into pairs of slices, each a task. A
   set's overlaps with all others are derived from those of the most similar
   set done before, by the index lists of the tokens in which the two differ.
4. Components of the verified links.

Defined results: a NULL or empty text has an empty set and links with
nothing; with fewer words than a shingle the whole sequence is the one shingle;
rows that share a doc_id are one node; NULL doc_id is one node that is larger
than the others (a component of it alone has a NULL id). Where ids are shared
or missing, the join runs over row numbers, with every row's set a set of its
own, and rows of one id are folded into their node at the end; class_id is then
the smallest doc_id with an equal set, n_links the row's own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.blocks import (
    BLOCK_BYTES,
    Block,
    joined,
    mix,
    pack,
    split_by_part,
    unpack,
    window_hashes,
    words_of,
    write_blocks,
)
from tripmart.llm.components import connected_components, join_counted
from tripmart.llm.cover_dedup import answer_per_block, repeated_in
from tripmart.session import cut_lineage, cut_observed

#: Defaults: words of a shingle, and similarity in percent.
SHINGLE = 4
PERCENT = 85
#: Sets of a candidate group that are compared in one task.
GROUP = 128
_BITS = 512
_NO_ID = np.iinfo(np.int64).max
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Sets:
    """The shingle sets of a block, as sorted tokens: those of document d are
    ``token[first[d]:first[d + 1]]``."""

    def __init__(self, block: Block, shingle: int = SHINGLE):
        data = _LOWER[block.data]
        words = words_of(block, data)
        n = len(block.ids)
        count = np.diff(words.first)
        hashes = window_hashes(words.code, *range(1, shingle + 1))
        whole = np.arange(len(hashes[-1]))
        whole = whole[words.first[words.doc[whole] + 1] - whole >= shingle]
        doc, token = words.doc[whole], hashes[-1][whole]
        bounds = np.searchsorted(doc, np.arange(n + 1)).tolist()
        for a, b in zip(bounds, bounds[1:]):
            token[a:b].sort()
        for size in range(1, shingle):  # fewer words: the whole sequence
            short = np.flatnonzero(count == size)
            at = np.searchsorted(doc, short)
            doc = np.insert(doc, at, short)
            token = np.insert(token, at, mix(hashes[size - 1][words.first[short]]
                                             + np.uint64(size)))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
        self.doc, self.token = doc[new], token[new]
        self.first = np.searchsorted(self.doc, np.arange(n + 1))
        self.size = np.diff(self.first)
        self.ids = np.array([_NO_ID if i is None else i for i in block.ids], np.int64)
        self.n_words = count
        total = np.zeros(len(self.token) + 1, np.uint64)
        np.cumsum(mix(self.token.copy()), dtype=np.uint64, out=total[1:])
        sums = total[self.first[1:]] - total[self.first[:-1]]
        self.content = mix(sums ^ mix(self.size.astype(np.uint64)))
        # the first document of each class; blocks are sorted by doc_id, NULL first
        by_class = np.lexsort((self.ids, self.content))
        head = np.ones(n, bool)
        head[1:] = self.content[by_class][1:] != self.content[by_class][:-1]
        self.head = np.empty(n, np.int64)
        self.head[by_class] = by_class[head][np.cumsum(head) - 1]
        self.own = self.head == np.arange(n)

    def drop(self, classes: dict[int, tuple[int, bool]]) -> None:
        """Leave classes to the block that holds their smallest doc_id."""
        others = np.array([c for c, (_, mine) in classes.items() if not mine], np.uint64)
        self.own &= ~np.isin(self.content, others)

    def index_entries(self, shared: np.ndarray, parts: int,
                      percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, place) of the prefix tokens of class heads that other sets may
        hold; the place is that in the order of tokens."""
        at = np.flatnonzero(self.own[self.doc])
        token, doc = self.token[at], self.doc[at]
        here = np.sort(token)
        common = (np.isin(_short(token, parts), shared)
                  | np.isin(token, here[repeated_in(here)]))
        single = np.bincount(doc[~common], minlength=len(self.size))
        at, doc = at[common], doc[common]  # by document and hash
        first = np.searchsorted(doc, np.arange(len(self.size)))
        place = single[doc] + np.arange(len(doc)) - first[doc]
        least = -(-percent * self.size // 100)
        prefix = place <= (self.size - least)[doc]
        return at[prefix], place[prefix]


def _short(token: np.ndarray, parts: int) -> np.ndarray:
    """A token by its part and 32 of its bits. Two tokens that agree in these
    count as held by several sets, in all blocks alike: that costs a
    comparison, and never a link."""
    part = (token >> np.uint64(33)) % np.uint64(parts)
    return part << np.uint64(32) | token & np.uint64(0xFFFFFFFF)


def _pack_short(keys: np.ndarray) -> bytes:
    """Short tokens of one part, as sorted differences after the part."""
    low = np.sort((keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
    step = np.diff(low, prepend=0).astype(np.uint32)
    return pack(step=np.concatenate([[np.uint32(int(keys[0]) >> 32)], step]).astype(np.uint32))


def _unpack_short(payload) -> np.ndarray:
    step = unpack(payload).column("step").to_numpy().astype(np.uint64)
    return step[0] << np.uint64(32) | np.cumsum(step[1:], dtype=np.uint64)


def _send_classes(parts: int, shingle: int):
    def message(block: Block):
        sets = Sets(block, shingle)
        heads = np.flatnonzero(sets.own & (sets.size > 0))
        for part, own in split_by_part(sets.content[heads], parts):
            yield part, pack(content=sets.content[heads[own]], id=sets.ids[heads[own]])

    return message


def _shared_classes(blocks, payloads):
    """Classes that two or more blocks hold, back to each of them, with the
    doc_id that the class is known by and whether it is this block's."""
    own = np.array(blocks)
    content, doc_id, owner = joined(payloads, "content", "id")
    order = np.lexsort((own[owner], doc_id, content))
    order = order[repeated_in(content[order])]
    if not len(order):
        return
    content, doc_id, owner = content[order], doc_id[order], owner[order]
    new = np.concatenate([[True], content[1:] != content[:-1]])
    known = doc_id[np.flatnonzero(new)][np.cumsum(new) - 1]
    yield from answer_per_block(blocks, owner, lambda i: pack(
        content=content[i], id=known[i], mine=new[i]))


def _classes(got) -> dict[int, tuple[int, bool]]:
    classes = {}
    for payload in got:
        table = unpack(payload)
        for c, i, mine in zip(*(table.column(k).to_pylist() for k in ("content", "id", "mine"))):
            classes[c] = (i, mine)
    return classes


def _send_tokens(parts: int, shingle: int):
    def message(block: Block, got):
        sets = Sets(block, shingle)
        sets.drop(_classes(got))
        tokens = np.unique(sets.token[sets.own[sets.doc]])
        for part, own in split_by_part(tokens, parts):
            yield part, _pack_short(np.unique(_short(tokens[own], parts)))

    return message


def _shared_tokens(blocks, payloads):
    """Tokens that two or more blocks hold, back to each of them."""
    arrays = [_unpack_short(p) for p in payloads]
    keys = np.concatenate(arrays)
    owner = np.repeat(np.arange(len(arrays), dtype=np.int32), [len(a) for a in arrays])
    del arrays
    order = np.argsort(keys, kind="stable")
    order = order[repeated_in(keys[order])]
    keys, owner = keys[order], owner[order]
    # one message holds the tokens of one part
    yield from answer_per_block(blocks, owner, lambda i: _pack_short(keys[i]))


def _sketches(sets: Sets, docs: np.ndarray) -> np.ndarray:
    """Parity of the tokens in each of 512 cells, a row of 8 words per document."""
    number = np.full(len(sets.size), -1)
    number[docs] = np.arange(len(docs))
    some = number[sets.doc] >= 0
    cell = number[sets.doc[some]] * _BITS + (sets.token[some] >> np.uint64(17)).astype(np.int64) % _BITS
    odd = (np.bincount(cell, minlength=len(docs) * _BITS) & 1).astype(bool)
    return np.packbits(odd.reshape(len(docs), _BITS), axis=1).view(np.uint64)


def _send_entries(parts: int, shingle: int, percent: int):
    def message(block: Block, got_classes, got_tokens):
        sets = Sets(block, shingle)
        sets.drop(_classes(got_classes))
        shared = np.concatenate([*map(_unpack_short, got_tokens), np.zeros(0, np.uint64)])
        index, place = sets.index_entries(shared, parts, percent)
        docs, number = np.unique(sets.doc[index], return_inverse=True)
        if not len(docs):
            return
        sketch = _sketches(sets, docs)
        doc = sets.doc[index]
        for part, k in split_by_part(sets.token[index], parts):
            cells = sketch[number[k]]
            yield part, pack(token=sets.token[index[k]], id=sets.ids[doc[k]],
                             size=sets.size[doc[k]].astype(np.int32),
                             place=place[k].astype(np.int32),
                             **{f"s{c}": cells[:, c] for c in range(_BITS // 64)})

    return message


class Forest:
    """Union-find over 0..n-1, with labels as an array."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, a, b) -> list[int]:
        """Indices of the pairs that joined two trees."""
        used = []
        for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                used.append(k)
        return used

    def labels(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up


def _next_group(label: np.ndarray) -> np.ndarray:
    """For every entry the next one with another label. An entry whose partners
    are all in its own group already is done."""
    ends = np.append(np.flatnonzero(label[1:] != label[:-1]), len(label) - 1)
    return np.repeat(ends + 1, np.diff(ends, prepend=-1))


def _candidates(percent: int):
    """Spanning edges of the candidate groups within a part's index lists."""
    def work(blocks, payloads):
        names = ["token", "id", "size", "place", *(f"s{c}" for c in range(_BITS // 64))]
        token, doc_id, size, place, *sketch, owner = joined(payloads, *names)
        order = np.lexsort((doc_id, size, token))
        token, doc_id, owner = token[order], doc_id[order], owner[order]
        size, place = size[order].astype(np.int64), place[order].astype(np.int64)
        sketch = np.stack(sketch, 1)[order]
        block = np.array(blocks)[owner]
        _, node = np.unique(doc_id, return_inverse=True)
        forest = Forest(int(node.max()) + 1)
        label = forest.labels()
        alive = np.arange(len(token))
        # lists are sorted by size: the last entry that isn't too large for one
        number = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) << 32
        reach = np.searchsorted(number + size, number + np.minimum(
            100 * size // percent, (1 << 32) - 1), "right") - 1
        lag = 0
        while True:
            lag += 1
            alive = alive[alive + lag <= reach[alive]]
            if lag & (lag - 1) == 0:
                alive = alive[_next_group(label[node])[alive] <= reach[alive]]
            if not len(alive):
                return
            a, b = alive, alive + lag
            both = size[a] + size[b]
            overlap = -(-percent * both // (100 + percent))
            left = 1 + np.minimum(size[a] - place[a], size[b] - place[b]) - 1
            pick = (left >= overlap) & (label[node[a]] != label[node[b]])
            a, b, room = a[pick], b[pick], (both - 2 * overlap)[pick]
            if not len(a):
                continue
            differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1, dtype=np.int64)
            a, b = a[differ <= room], b[differ <= room]
            used = forest.join(node[a], node[b])
            if used:
                label = forest.labels()
                yield from zip(doc_id[a[used]].tolist(), block[a[used]].tolist(),
                               doc_id[b[used]].tolist(), block[b[used]].tolist())

    return work


def _send_sets(parts: int, group: int, shingle: int):
    def message(block: Block, got):
        calls = {x["id"] for x in got}
        block = block.only([d for d, i in enumerate(block.ids)
                            if (_NO_ID if i is None else i) in calls])
        if not block.ids:
            return
        sets = Sets(block, shingle)
        places: dict[int, int] = {}
        for d in np.flatnonzero(sets.own & (sets.size > 0))[::-1].tolist():
            places[int(sets.ids[d])] = d
        rows = [(places[x["id"]], x["component"], -(-x["n"] // group)) for x in got
                if x["id"] in places]
        if not rows:
            return
        doc, component, slices = (np.array(x, np.int64) for x in zip(*rows))
        own = (mix(sets.ids[doc].astype(np.uint64)) % slices.astype(np.uint64)).astype(np.int64)
        # a set of slice s goes to the tasks (i, j), i <= j, with s in {i, j}
        row = np.repeat(np.arange(len(doc)), slices)
        other = np.arange(len(row)) - np.repeat(np.cumsum(slices) - slices, slices)
        i, j = np.minimum(own[row], other), np.maximum(own[row], other)
        key = mix(component[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                  + (i * slices[row] + j).astype(np.uint64))
        key = mix(key + np.uint64(1))
        for part, k in split_by_part(key, parts):
            d = doc[row[k]]
            lengths = sets.size[d]
            at = np.repeat(sets.first[d] - np.cumsum(lengths) + lengths, lengths)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            tokens = pa.LargeListArray.from_arrays(offsets, sets.token[at + np.arange(len(at))])
            # a task of one slice compares all pairs, one of two only across
            side = np.where(i[k] == j[k], -1, (own[row[k]] == j[k]).astype(np.int64))
            yield part, pack(key=key[k], id=sets.ids[d], side=side, tokens=tokens)

    return message


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Overlap of every two sets. The overlaps of a set are those of the most
    similar set done before, corrected by the index lists of the tokens in
    which the two differ; without a similar one, the sum of all its lists."""
    n = len(sets)
    member = np.repeat(np.arange(n), [len(s) for s in sets])
    token, number, count = np.unique(np.concatenate(sets), return_inverse=True,
                                     return_counts=True)
    order = np.argsort(number, kind="stable")
    lists = member[order]
    start = np.cumsum(count) - count
    own = np.split(number, np.cumsum([len(s) for s in sets])[:-1])

    def add_up(tokens: np.ndarray) -> np.ndarray:
        size = count[tokens]
        at = np.repeat(start[tokens] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(lists[at], minlength=n)

    size = np.array([len(s) for s in sets])
    out = np.zeros((n, n), np.int64)
    for x in range(n):
        if x:
            differ = size[x] + size[:x] - 2 * out[:x, x]
            y = int(differ.argmin())
        if x and differ[y] < size[x] // 2:
            more = np.setdiff1d(own[x], own[y], assume_unique=True)
            less = np.setdiff1d(own[y], own[x], assume_unique=True)
            out[x] = out[y] + add_up(more) - add_up(less)
        else:
            out[x] = add_up(own[x])
        out[:x, x] = out[x, :x]
    return out


def _verify(percent: int):
    """(a, b, 0): spanning edges of verified links; (a, a, n): a has n links."""
    def work(blocks, payloads):
        tables = [unpack(p) for p in payloads]
        key, doc_id, side, _ = joined(payloads, "key", "id", "side")
        sets = [s for t in tables for c in t.column("tokens").chunks for s in
                (c.values.to_numpy()[a:b] for a, b in zip(c.offsets.to_numpy()[:-1],
                                                          c.offsets.to_numpy()[1:]))]
        order = np.lexsort((doc_id, key))
        bounds = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1], [True]]))
        for a, b in zip(bounds[:-1], bounds[1:]):
            rows = order[a:b]
            own, ids, sides = [sets[r] for r in rows], doc_id[rows], side[rows]
            size = np.array([len(s) for s in own])
            common = _overlaps(own)
            link = 100 * common >= percent * (size[:, None] + size[None, :] - common)
            np.fill_diagonal(link, False)
            if (sides >= 0).all():
                link &= sides[:, None] != sides[None, :]
            for i, n in zip(ids.tolist(), link.sum(1).tolist()):
                if n:
                    yield i, i, n
            x, y = np.nonzero(np.triu(link))
            used = Forest(len(rows)).join(x, y)
            yield from ((p, q, 0) for p, q in zip(ids[x[used]].tolist(), ids[y[used]].tolist()))

    return work


def _rows(shingle: int):
    def rows(block: Block, got, found) -> pa.RecordBatch:
        sets = Sets(block, shingle)
        classes = _classes(got)
        component = {x["id"]: (x["component"], x["n"]) for x in found}
        class_id, out, links = [], [], []
        for d, size in enumerate(sets.size.tolist()):
            own = int(sets.ids[sets.head[d]]) if size else int(sets.ids[d])
            if size:
                own = classes.get(int(sets.content[d]), (own, True))[0]
            best, n = component.get(own, (own, 0)) if size else (own, 0)
            class_id.append(None if own == _NO_ID else own)
            out.append(None if best == _NO_ID else best)
            links.append(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(block.ids, pa.int64()), pa.array(sets.size, pa.int64()),
             pa.array(out, pa.int64()), pa.array(class_id, pa.int64()), pa.array(links, pa.int64())],
            ["doc_id", "n_shingles", "component_id", "class_id", "n_links"])

    return rows


def ngram_join(docs: DataFrame, block_bytes: int = BLOCK_BYTES, group: int = GROUP,
               shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, class_id (smallest
    doc_id with an equal set) and n_links (links to different sets). Shingles
    have ``shingle`` words; sets link from a similarity of ``percent`` on."""
    if shingle < 1 or not 1 <= percent <= 100:
        raise ValueError("shingle must be 1 or more, percent 1 to 100")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    seen = ids.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    if seen.n == seen.ids:
        return _join_sets(docs, block_bytes, group, shingle, percent)
    rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"),
                                   F.col("doc_id").cast("long").alias("known_as"), "text"),
                       "numbered_rows")
    found = cut_lineage(_join_sets(rows.select(F.col("row").alias("doc_id"), "text"),
                                   block_bytes, group, shingle, percent), "joined_rows")
    return _fold(rows.select("row", "known_as"), found)


def _fold(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Results over row numbers as results over doc_ids: rows of one id are one
    node, so the components they lie in are one."""
    every = rows.join(found, F.col("row") == F.col("doc_id")).drop("doc_id")
    every = cut_lineage(every.withColumn("key", F.coalesce("known_as", F.lit(int(_NO_ID)))),
                        "keyed_rows")
    places = every.select("key", "component_id").distinct()
    least = places.groupBy("key").agg(F.min("component_id").alias("a"))
    whole = connected_components(places.join(least, "key").select(
        "a", F.col("component_id").alias("b")))
    names = every.join(whole, F.col("component_id") == F.col("id")).groupBy(
        F.col("id").alias("component_id")).agg(F.first("component").alias("component"),
                                               F.min("key").alias("key"))
    least = names.groupBy("component").agg(F.min("key").alias("least"))
    names = names.select("component_id", "component").join(least, "component")
    classes = every.groupBy("class_id").agg(F.min("key").alias("class_key"))

    def known(key):
        return F.when(F.col(key) != int(_NO_ID), F.col(key))

    # a set without shingles is linked with nothing but the rows of its doc_id
    return every.join(names.select("component_id", "least"), "component_id").join(
        classes, "class_id").select(
        F.col("known_as").alias("doc_id"), "n_shingles", known("least").alias("component_id"),
        known("class_key").alias("class_id"), "n_links")


def _join_sets(docs: DataFrame, block_bytes: int, group: int, shingle: int,
               percent: int) -> DataFrame:
    """The join over unique doc_ids."""
    blocks = write_blocks(docs, block_bytes=block_bytes)
    parts = blocks.parts
    classes = cut_lineage(blocks.exchange(blocks.send(_send_classes(parts, shingle)), _shared_classes),
                          "shared_classes")
    tokens = blocks.exchange(blocks.send(_send_tokens(parts, shingle), classes), _shared_tokens)
    edges = cut_lineage(blocks.exchange(
        blocks.send(_send_entries(parts, shingle, percent), classes, tokens),
        _candidates(percent), "a long, block_a long, b long, block_b long"), "candidates")
    groups, seen = cut_observed(connected_components(edges), "candidate_groups",
                                [F.count(F.lit(1)).alias("n")])
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    homes = edges.select(F.col("a").alias("id"), F.col("block_a").alias("block")).union(
        edges.select(F.col("b").alias("id"), F.col("block_b").alias("block"))).distinct()
    calls = homes.join(join_counted(groups, sizes, "component", seen["n"]), "id").select(
        "block", F.struct("id", "component", "n").alias("payload"))
    verified = cut_lineage(blocks.exchange(blocks.send(_send_sets(parts, group, shingle), calls),
                                           _verify(percent), "a long, b long, n long"), "verified")
    linked = connected_components(verified)
    counts = verified.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    result = cut_lineage(linked.join(counts, "id"), "components")
    # every block that holds a class asks for the class's component
    holders = homes.union(classes.mapInArrow(_class_ids, "id long, block long")).distinct()
    found = holders.join(result, "id").select("block", F.struct("id", "component", "n")
                                              .alias("payload"))
    return blocks.finish(_rows(shingle), "doc_id long, n_shingles long, component_id long, class_id long, "
                         "n_links long", classes, found)


def _class_ids(batches):
    """Classes that a block holds copies of."""
    for batch in batches:
        rows = [(i, block) for block, payload in zip(batch.column(0).to_pylist(), batch.column(1))
                for i, mine in _classes([payload.as_buffer()]).values() if not mine]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                             ["id", "block"])
