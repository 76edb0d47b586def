"""Exact dedup against a persistent digest index.

The index is a parquet table bucketed and sorted by digest under a path the
caller owns; it outlives the session (``open_index`` re-attaches it), and its
buckets are dealt anew when they have outgrown their size. A batch
is reduced to one row per digest before it meets the index, so a digest that
a third of all rows share is one row in the sort-merge join; only new digests
are appended.

Defined results: a NULL text counts as empty; all empty texts are one group.
Of equal texts the row with the most code points stays, then the smallest
doc_id (NULL last); of rows repeated in full exactly one stays. A digest
already in the index keeps its indexed doc_id, so running the same batch
again gives the same decisions.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.session import cut_lineage, cut_observed

#: Fixed value: the characters that normalisation deletes, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: Buckets of a new index, and rows that a bucket should hold.
LEAST_BUCKETS = 64
ROWS_PER_BUCKET = 1 << 20
_MARKER = "_INDEX"


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text without white space, in UTF-8."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, "").cast("binary"), 256)


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@dataclass
class DigestIndex:
    """A bucketed table of (digest, keep_id, n_chars) under ``path``, for one
    writer at a time. Its folder is named by the number of buckets, which grows
    with the index (``make_room``); a folder counts once it holds the marker."""

    spark: SparkSession
    path: str
    buckets: int
    rows_per_bucket: int
    table: str = ""

    def _attach(self, buckets: int) -> str:
        table = f"digest_index_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {table} (digest STRING, keep_id BIGINT, n_chars INT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS "
            f"LOCATION '{self._place(buckets)}'")
        return table

    def _place(self, buckets: int) -> str:
        return f"{self.path.rstrip('/')}/buckets={int(buckets)}"

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, rows: DataFrame) -> None:
        """Add rows of new digests, one sorted file per bucket."""
        (rows.select("digest", "keep_id", "n_chars").repartition(self.buckets, "digest")
             .write.insertInto(self.table))
        self.spark.catalog.refreshTable(self.table)

    def make_room(self, more: int) -> None:
        """Deal the index into more buckets if ``more`` rows would make them
        twice as large as they should be. An empty index gets what it needs."""
        held = self.read().count()  # from the files' footers
        wanted = -(-(held + more) // self.rows_per_bucket)
        if wanted <= self.buckets * (2 if held else 1):
            return
        old, old_place = self.table, self._place(self.buckets)
        rows, self.buckets = self.read(), wanted
        fs, place = _folder(self.spark, self._place(wanted))
        fs.delete(place, True)  # of a writer that was lost before its marker
        self.table = self._attach(wanted)
        if held:
            self.append(rows)
        self._mark()
        self.spark.sql(f"DROP TABLE {old}")
        fs, place = _folder(self.spark, old_place)
        fs.delete(place, True)

    def _mark(self) -> None:
        fs, marker = _folder(self.spark, f"{self._place(self.buckets)}/{_MARKER}")
        fs.create(marker, True).close()

    def close(self) -> None:
        """Forget the table's name in the catalog; the index stays at its path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def open_index(spark: SparkSession, path: str, buckets: int = LEAST_BUCKETS,
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DigestIndex:
    """Attach the index under ``path``, creating it if there is none, with
    ``buckets`` buckets to begin with."""
    fs, root = _folder(spark, path)
    sizes = [int(s.getPath().getName().split("=")[1]) for s in
             (fs.listStatus(root) if fs.exists(root) else [])
             if s.getPath().getName().startswith("buckets=")]
    marked = [n for n in sizes if fs.exists(_folder(spark, f"{path}/buckets={n}/{_MARKER}")[1])]
    index = DigestIndex(spark, path, max(marked, default=buckets), rows_per_bucket)
    if not marked:
        at, place = _folder(spark, index._place(buckets))
        at.delete(place, True)
    index.table = index._attach(index.buckets)
    if not marked:
        index._mark()
    return index


def digest_rows(docs: DataFrame) -> tuple[DataFrame, int]:
    """One narrow row per document, written once so that the texts are read
    once; and how many there are."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.char_length("text"), F.lit(0)).alias("n_chars"),
        text_digest(F.col("text")).alias("digest"),
        F.monotonically_increasing_id().alias("row_tag"))
    rows, seen = cut_observed(rows, "digests", [F.count(F.lit(1)).alias("n")])
    return rows, seen["n"]


def _best() -> Column:
    # max() of this struct: most code points, then a known id, then the smallest
    # id (bitwise not turns the order round without overflow), then one row.
    doc = F.col("doc_id")
    return F.max(F.struct("n_chars", doc.isNotNull(), F.bitwise_not(doc),
                          F.bitwise_not(F.col("row_tag")))).alias("best")


def exact_dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Decide every row of ``docs`` against ``index`` and append new digests.

    Returns doc_id, keep_id, group_size (rows of this batch with that text),
    kept, text_sha256 and row_tag (which tells repeated rows apart).
    """
    rows, total = digest_rows(docs)
    index.make_room(total)
    groups = rows.groupBy("digest").agg(_best(), F.count(F.lit(1)).alias("group_size")).select(
        "digest", "group_size", F.col("best")["n_chars"].alias("n_chars"),
        F.bitwise_not(F.col("best")["col3"]).alias("best_id"),
        F.bitwise_not(F.col("best")["col4"]).alias("best_tag"))
    known = index.read().select("digest", F.col("keep_id").alias("known_id"),
                                F.lit(True).alias("known"))
    decided = cut_lineage(
        groups.hint("merge").join(known, "digest", "left")
              .withColumn("known", F.coalesce("known", F.lit(False))), "digest_groups")
    # anti-join of the batch against the index: digests without a partner are new
    index.append(decided.filter(~F.col("known")).withColumn("keep_id", F.col("best_id")))
    decided = decided.select(
        "digest", "group_size", "best_tag", "best_id",
        F.when(F.col("known"), F.col("known_id")).otherwise(F.col("best_id")).alias("keep_id"))
    # The best row of a known digest stays only if it is the indexed one.
    stays = ((F.col("row_tag") == F.col("best_tag"))
             & F.col("best_id").eqNullSafe(F.col("keep_id")))
    return rows.join(decided, "digest").select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"),
        F.col("digest").alias("text_sha256"), "row_tag")


def keep_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns. Rows are matched
    by doc_id and digest; of rows equal in both, one stays."""
    stay = decisions.filter("kept").select(F.col("doc_id").alias("stay_id"),
                                           F.col("text_sha256").alias("stay_digest"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                       F.col("doc_id").cast("long").alias("row_id"),
                       text_digest(F.col("text")).alias("row_digest"))
    same = Window.partitionBy("row_id", "row_digest").orderBy(
        F.char_length("doc.text").desc_nulls_last())
    on = (F.col("row_digest") == F.col("stay_digest")) & F.col("row_id").eqNullSafe(F.col("stay_id"))
    return (rows.join(stay, on, "left_semi").withColumn("nth", F.row_number().over(same))
            .filter("nth = 1").select("doc.*"))
