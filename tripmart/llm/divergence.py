"""Quality rules: is a text distributed like its language?

Every document gets two histograms: its characters over seven classes, and
the common words of its language (all others are one cell). The reference of a
language is the sum of the histograms of all its documents that pass the base
rules; every value of lang has one. A document is kept if both Jensen-Shannon
distances (base 2, so 0 to 1) to the reference of its language are within
limits. The limit for words follows from the language and the length: a share
of the distance of a text without any common word, and what a sample of that
many words drawn from the reference itself is away from it. One without a language is compared to the characters of every language
and has the smallest distance; if no row has a language, to those of all rows.
Guards: a histogram with too little in it isn't compared, nor are the words of
a language without a word list here.

Plain Spark SQL throughout: words stay in an array of their row, so nothing
is exploded or shuffled but one row of sums per language and task.

Defined results: a NULL text has no words and fails the base rules; rows that
share a doc_id are judged separately.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.enrich import fits_broadcast
from tripmart.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Character classes, in the order in which they are taken out
#: of a text; what is left over is the last class.
CLASSES = (r"[a-z]+", r"[\x20\x09-\x0D]+", r"\p{Lu}+", r"\p{L}+", r"\p{N}+", r"\p{P}+")
#: Common words.
COMMON_WORDS = {
    "de": ("auf das den der die ein eine für in ist mit nicht sich sie und von werden wie zu "
           "über").split(),
    "en": "a and are be by for from in is it not of on that the this to was with you".split(),
    "es": "a con de del el en es la las lo los no para por que se su un una y".split(),
    "fr": "au avec ce dans de des du elle en est et la le les par pas pour que un une".split(),
}
LEAST_WORDS = 50
#: Limit of the characters' distance; the words' one as a share of the distance
#: of a text without common words; the least that is compared.
CHAR_LIMIT = 0.28
WORD_SHARE = 0.6
LEAST_CHARS = 200
LEAST_COMPARED = LEAST_WORDS
#: Languages whose references are broadcast; those of more are joined by a shuffle.
MAX_LANGUAGES = 10_000
_PLACE = 28  # bits for a word's place while triples are sorted


def _count(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _repeat_words(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in 3-word windows that the text has twice or
    more. Windows are sorted by 36 bits of their hash with the place below, to
    find the few that may repeat; those are compared by the whole hash."""
    word = F.col("words")
    rows = rows.withColumn("triples", F.when(
        F.col("n_words") >= 3,
        F.transform(F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int")),
                    lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("packed", F.sort_array(F.transform("triples", lambda h, i: F.shiftleft(
        F.shiftright(h, _PLACE), _PLACE).bitwiseOR(i.cast("long")))))
    packed = F.col("packed")

    def near(k: Column, j: Column) -> Column:
        other = F.get(packed, j)
        return F.coalesce(F.shiftright(other, _PLACE) == F.shiftright(k, _PLACE), F.lit(False))

    places = F.transform(F.filter("packed", lambda k, j: near(k, j - 1) | near(k, j + 1)),
                         lambda k: k.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int"))
    rows = rows.withColumn("places", places)
    # by hash, then place
    rows = rows.withColumn("found", F.array_sort(F.transform(
        "places", lambda i: F.struct(F.get("triples", i).alias("h"), i.alias("i")))))
    found = F.col("found")

    def equal(x: Column, j: Column) -> Column:
        return F.coalesce(F.get(found, j)["h"] == x["h"], F.lit(False))

    rows = rows.withColumn("repeats", F.sort_array(F.transform(
        F.filter("found", lambda x, j: equal(x, j - 1) | equal(x, j + 1)), lambda x: x["i"])))
    repeats = F.col("repeats")
    # windows at sorted places cover 3 words each, less what they share
    covers = F.transform("repeats", lambda p, j: F.when(j == 0, F.lit(3)).otherwise(
        F.least(F.lit(3), p - F.get(repeats, j - 1))))
    return rows.withColumn("n_repeat_words", F.aggregate(
        covers, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")))


def document_features(docs: DataFrame) -> DataFrame:
    """One narrow row per document: base counts and the two histograms."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("lang").cast("string").alias("lang"), text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    rows = rows.withColumns({"lines": lines, "n_symbols": _count(F.col("text"), SYMBOLS),
                             "left0": F.col("text")})
    rows = rows.withColumn("n_dup_lines",
                           F.size("lines") - F.size(F.array_distinct("lines"))).drop("lines")
    rows = _repeat_words(rows)
    common = sorted({w for words in COMMON_WORDS.values() for w in words})
    rows = rows.withColumn("common", F.filter(F.transform("words", F.lower),
                                              lambda x: x.isin(common)))
    counts = F.lit(None).cast("array<int>")
    for lang, words in COMMON_WORDS.items():
        counts = F.when(F.col("lang") == lang, F.array(*[
            F.size("common") - F.size(F.array_remove("common", w)) for w in words])
        ).otherwise(counts)
    others = F.size("words") - F.aggregate(counts, F.lit(0), lambda s, v: s + v)
    counts = F.concat(counts, F.array(others))
    rows = rows.withColumn("word_counts", counts).drop("words", "common", "triples", "packed",
                                                       "places", "found", "repeats")
    sizes = [F.char_length("left0")]
    for k, pattern in enumerate(CLASSES):
        rows = rows.withColumn(f"left{k + 1}", F.regexp_replace(f"left{k}", pattern, ""))
        sizes.append(F.char_length(f"left{k + 1}"))
    classes = [a - b for a, b in zip(sizes, sizes[1:])] + [sizes[-1]]
    return rows.select(
        "doc_id", "lang", "n_words", (sizes[0] - classes[1]).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.array(*classes).alias("char_counts"), "word_counts")


def _sums(column: str, n: int) -> Column:
    return F.array(*[F.sum(F.get(column, k).cast("long")) for k in range(n)])


def _entropy_term(p: Column, m: Column) -> Column:
    return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda s, v: s + v.cast("double"))


def jensen_shannon(a: Column, b: Column, total_a: Column, total_b: Column) -> Column:
    """Distance of two histograms (arrays of counts of one length) with their
    totals; NULL if one is empty. The totals should be columns: inside, they
    are read once per cell."""
    def term(x: Column) -> Column:
        p, q = x["p"] / total_a, x["q"] / total_b
        m = (p + q) / 2
        return (_entropy_term(p, m) + _entropy_term(q, m)) / 2

    pairs = F.arrays_zip(a.alias("p"), b.alias("q"))
    divergence = F.aggregate(F.transform(pairs, term), F.lit(0.0), lambda s, v: s + v)
    return F.when((total_a > 0) & (total_b > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def _word_limit(all_words: Column, ref_words: Column, n_words: Column, share: float) -> Column:
    """Squares add: ``share`` of the distance between the reference and a text of
    other words only, and the expected sampling divergence of n words,
    (cells - 1) / (8 ln 2 n)."""
    others = F.element_at(all_words, -1) / F.nullif(ref_words, F.lit(0.0))
    bare = ((1 - others) + _entropy_term(others, (1 + others) / 2)
            - F.log2((1 + others) / 2)) / 2
    return F.sqrt(F.lit(share * share) * bare
                  + (F.size(all_words) - 1) / (8 * math.log(2) * n_words))


def _with_references(rows: DataFrame, references: DataFrame) -> DataFrame:
    """Adds the sums of the row's language (all_chars, all_words), or for rows
    without one the characters of all languages (near)."""
    one = F.struct(F.col("all_chars").alias("counts"), total(F.col("all_chars")).alias("total"))
    named = F.col("ref_lang").isNotNull()
    near = references.agg(F.collect_list(F.when(named, one)).alias("others"),
                          F.collect_list(F.when(~named, one)).alias("own"))
    near = near.select(F.lit(None).cast("string").alias("ref_lang"),
                       F.when(F.size("others") > 0, F.col("others")).otherwise(F.col("own"))
                       .alias("near"))
    table = references.filter(named).unionByName(near, allowMissingColumns=True)
    if fits_broadcast(references, MAX_LANGUAGES):
        table = F.broadcast(table)
    return rows.join(table, rows["lang"].eqNullSafe(table["ref_lang"]), "left")


def quality_rules(docs: DataFrame, char_limit: float = CHAR_LIMIT,
                  word_share: float = WORD_SHARE) -> DataFrame:
    """Per document: the base counts, base_failed, kept, both distances and the
    words' limit."""
    rows = cut_lineage(document_features(docs), "quality_features")
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    rows = rows.withColumn("base_failed", failed)
    some = next(iter(COMMON_WORDS.values()))
    references = cut_lineage(
        rows.filter(~F.col("base_failed")).groupBy(F.col("lang").alias("ref_lang"))
        .agg(_sums("char_counts", len(CLASSES) + 1).alias("all_chars"),
             _sums("word_counts", len(some) + 1).alias("all_words")), "quality_references")
    rows = _with_references(rows, references)
    rows = rows.withColumns({"chars": total(F.col("char_counts")),
                             "words": total(F.col("word_counts")),
                             "ref_chars": total(F.col("all_chars")),
                             "ref_words": total(F.col("all_words"))})
    rows = rows.withColumns({
        "char_distance": F.when(F.col("chars") >= LEAST_CHARS, F.when(
            F.col("lang").isNull(), F.array_min(F.transform("near", lambda r: jensen_shannon(
                F.col("char_counts"), r["counts"], F.col("chars"), r["total"]))))
            .otherwise(jensen_shannon(F.col("char_counts"), F.col("all_chars"), F.col("chars"),
                                      F.col("ref_chars")))),
        "word_distance": F.when(F.col("n_words") >= LEAST_COMPARED, jensen_shannon(
            F.col("word_counts"), F.col("all_words"), F.col("words"), F.col("ref_words"))),
        "word_limit": F.when(F.col("n_words") >= LEAST_COMPARED, _word_limit(
            F.col("all_words"), F.col("ref_words"), F.col("n_words"), word_share))})
    like = (F.coalesce(F.col("char_distance") <= char_limit, F.lit(True))
            & F.coalesce(F.col("word_distance") <= F.col("word_limit"), F.lit(True)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", (~F.col("base_failed") & like).alias("kept"),
                       "char_distance", "word_distance", "word_limit")
