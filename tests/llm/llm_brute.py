"""Plain versions of the operators, for small inputs."""

import hashlib
import re

WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def suffix_dedup(rows, length=100):
    """rows: (doc_id, text) in order; a list of (id, bytes, removed, spans, sha256)."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            part = data[s:s + length]
            if part in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), len(re.findall(b"\1+", gone)),
                    hashlib.sha256(kept).hexdigest()))
    return out


def cover_dedup(rows, length=20):
    seen, out = set(), []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            part = tuple(w[s:s + length])
            if part in seen:
                gone[s:s + length] = [True] * length
            seen.add(part)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, size=4):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*(w[k:] for k in range(size))))


def ngram_join(rows, shingle=4, percent=85):
    """{doc_id: (set size, component, links to different sets)}; unique ids."""
    sets = {i: shingles(t, shingle) for i, t in rows}
    parent = {i: i for i in sets}
    links = {i: set() for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
                if sets[a] != sets[b]:
                    links[a].add(frozenset(sets[b]))
                    links[b].add(frozenset(sets[a]))
    return {i: (len(sets[i]), root(i), len(links[i])) for i in ids}


def base_counts(text):
    text = text or ""
    w = words(text)
    triples = list(zip(w, w[1:], w[2:]))
    many = {t for t in triples if triples.count(t) > 1} if len(w) < 3000 else set()
    inside = {s + k for s, t in enumerate(triples) if t in many for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside),
            len(w) < 50 or 100 * len(inside) > 50 * len(w))
