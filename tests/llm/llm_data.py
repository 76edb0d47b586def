"""Small inputs with every awkward case."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, block string, "
          "payload string, digest string, doc string, `key` string, size string, p string, "
          "mix_key string, row_id string, kind string, words string")
EXTRA = ("x",) * 11


def row(i, text, lang="en", source="s1"):
    return (i, text, lang, source, len(text) if text is not None else None, *EXTRA)


def prose(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" + rng.choice(["", "", ",", ".\n"])
                    for _ in range(n))


def edge_rows():
    """NULLs in every column, empty and blank texts, a long one, repeated rows, ties."""
    rng = random.Random(5)
    long = prose(rng, 9000, 10 ** 6)
    same = prose(rng, 80)
    return [row(1, None), row(2, ""), row(3, " \t\n\x0b\r "), row(4, long), row(5, long + " more"),
            row(6, same), row(6, same), row(7, same + " "), row(None, same),
            row(None, "a null id here"), row(8, "short"), row(9, "Short"), row(10, "a b c"),
            row(11, "é😀漢 " * 40), (12, "no lang or source", None, None, None, *[None] * 11),
            row(13, "a" * 500), row(14, "\x00 zero " * 30), row(15, "12 34 !!")]


def corpus(seed, n=60, copies=True):
    """Documents that share passages, near copies and whole texts."""
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(8, 60)) for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if copies and texts and kind < 0.2:
            texts.append(rng.choice(texts))
        elif copies and texts and kind < 0.5:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            texts.append(" ".join(w))
        else:
            texts.append(" ".join([prose(rng, rng.randint(0, 80), 10 ** 6), rng.choice(passages),
                                   prose(rng, rng.randint(0, 80), 10 ** 6)]))
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(spark, pairs):
    return frame(spark, [row(i, t) for i, t in pairs])
