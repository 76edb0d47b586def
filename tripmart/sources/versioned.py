"""K7: versioned tables. A snapshot is a manifest of immutable files, by bucket.

Rows are dealt to buckets by a hash of the key; within a bucket they lie in
order of (key, order column), in as many files as the bucket needs, so a key
that holds a third of the rows is many files. The manifest has one row per
file: bucket, rows, and the smallest and largest key and order value.

* **Copy on write**: a commit names the files of the buckets that it rewrites
  and takes over all others by name, so a batch on one bucket writes one
  bucket.
* **Optimistic commits**: a commit records its parent. It is published by
  renaming a finished file to the next number, which fails if that number
  is taken (atomic on HDFS; a store without such a rename needs a
  conditional put behind its FileContext). The loser gets ``CommitConflict``
  and nothing of it is visible; it can run again on the new snapshot.
* **Lookups** read the manifest first: the buckets of the wanted keys, then
  files whose key and order ranges meet the request.

Commits carry facts about the whole table (rows, the largest surrogate key,
violations per bucket in the manifest), so that a batch needs no scan of the
buckets that it leaves alone.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "_commits"
#: Rows that a bucket should hold, and the most buckets of a table.
ROWS_PER_BUCKET = 1 << 20
MOST_BUCKETS = 1 << 16
BUCKET = "_bucket"


class CommitConflict(RuntimeError):
    """Another writer has published the snapshot that this one aimed at."""


@dataclass
class Version:
    """One committed snapshot."""

    number: int
    parent: int
    buckets: int
    rows: int
    manifest: str
    facts: dict = field(default_factory=dict)


class VersionedTable:
    """A table of ``schema`` under ``root``, bucketed by ``key``, in order of
    (key, ``order``)."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, order: str,
                 rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.order, self.rows_per_bucket = key, order, rows_per_bucket
        ordered = schema[order].dataType
        self._manifest_schema = T.StructType([
            T.StructField("file", T.StringType()), T.StructField("bucket", T.IntegerType()),
            T.StructField("rows", T.LongType()), T.StructField("bytes", T.LongType()),
            T.StructField("min_key", schema[key].dataType),
            T.StructField("max_key", schema[key].dataType),
            T.StructField("min_order", ordered), T.StructField("max_order", ordered),
            T.StructField("violations", T.LongType())])

    @classmethod
    def at(cls, spark: SparkSession, root: str,
           schema: T.StructType | None = None) -> "VersionedTable":
        """The table under a folder, by what its commits say."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{COMMITS}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        newest = max(s.getPath().getName() for s in fs.listStatus(path)
                     if s.getPath().getName().isdigit())
        probe = cls.__new__(cls)
        probe.spark, probe.root = spark, root.rstrip("/")
        text = json.loads(probe._read_text(probe._path(COMMITS, newest)))
        shape = text["facts"]["shape"]
        return cls(spark, root, schema or T.StructType.fromJson(json.loads(shape["schema"])),
                   shape["key"], shape["order"])

    # --- file system -----------------------------------------------------------
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _read_text(self, path) -> str:
        stream = self._fs().open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _publish(self, number: int, text: str) -> None:
        """A finished file takes the number, or the commit is lost."""
        jvm, fs = self.spark._jvm, self._fs()
        draft = self._path(COMMITS, f".draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(draft, self._path(COMMITS, f"{number:012d}"),
                           self.spark.sparkContext._gateway.new_array(kind, 0))
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise CommitConflict(f"{self.root}: snapshot {number} has been published by "
                                     "another writer") from None
            raise

    # --- versions --------------------------------------------------------------
    def versions(self) -> list[int]:
        """Numbers of the committed snapshots, ascending."""
        fs, folder = self._fs(), self._path(COMMITS)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self, number: int | None = None) -> Version | None:
        """A committed snapshot, the newest by default; None if there is none."""
        if number is None:
            number = max(self.versions(), default=None)
            if number is None:
                return None
        return Version(**json.loads(self._read_text(self._path(COMMITS, f"{number:012d}"))))

    def manifest(self, version: Version | None) -> DataFrame:
        """One row per file of the snapshot (no rows without a snapshot)."""
        if version is None:
            return self.spark.createDataFrame([], self._manifest_schema)
        return self.spark.read.schema(self._manifest_schema).parquet(
            f"{self.root}/{version.manifest}")

    # --- reading ---------------------------------------------------------------
    def bucket_of(self, key: Column, version: Version) -> Column:
        """The bucket of a key; a NULL key lies in bucket 0."""
        return F.when(key.isNull(), 0).otherwise(
            F.pmod(F.xxhash64(key), F.lit(version.buckets))).cast("int")

    def files(self, version: Version | None, buckets: list[int] | None = None, keys=None,
              since=None, until=None) -> list[str]:
        """Files that can hold rows of the buckets or keys whose order value
        lies in [since, until]."""
        if version is None:
            return []
        found = self.manifest(version)
        if keys is not None:
            kind = self.schema[self.key].dataType
            wanted = self.spark.createDataFrame([(k,) for k in keys],
                                                T.StructType([T.StructField("k", kind)]))
            wanted = wanted.withColumn("b", self.bucket_of(F.col("k"), version))
            found = found.join(F.broadcast(wanted), (F.col("bucket") == F.col("b"))  # a few keys
                               & F.col("k").between(F.col("min_key"), F.col("max_key")),
                               "left_semi")
        if buckets is not None:
            found = found.filter(F.col("bucket").isin(buckets))
        if since is not None:
            found = found.filter(F.col("max_order") >= since)
        if until is not None:
            found = found.filter(F.col("min_order") <= until)
        return [f"{self.root}/{r.file}" for r in found.select("file").orderBy("file").collect()]

    def violations_outside(self, version: Version, touched: list[int] | None) -> int:
        """Violations that the manifest notes for buckets besides the touched ones."""
        if touched is None or not version.manifest:
            return 0
        rest = self.manifest(version).filter(~F.col("bucket").isin(touched) if touched
                                             else F.lit(True))
        return rest.agg(F.sum("violations")).first()[0] or 0

    def _rows(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def read(self, version: Version | None = None, **wanted) -> DataFrame:
        """Rows of a snapshot (default: the newest), or of the files that
        ``files(version, **wanted)`` names. Callers filter the rows."""
        version = version or self.version()
        return self._rows(self.files(version, **wanted))

    def rows_of(self, *keys, since=None, until=None, version: Version | None = None) -> DataFrame:
        """All rows of a few keys, read from their files alone."""
        out = self.read(version, keys=list(keys), since=since, until=until)
        return out.filter(F.col(self.key).isin(list(keys)))

    def buckets_of(self, keys: DataFrame, version: Version) -> list[int]:
        """The buckets (at most ``version.buckets``) of a table of keys."""
        column = keys.select(self.bucket_of(F.col(self.key).cast(
            self.schema[self.key].dataType), version).alias("b"))
        return sorted(r.b for r in column.distinct().collect())

    # --- writing ---------------------------------------------------------------
    def plan(self, rows: int) -> Version:
        """What a first snapshot (or one with new buckets) is committed on."""
        buckets = max(1, min(MOST_BUCKETS, -(-rows // self.rows_per_bucket)))
        return Version(0, 0, buckets, 0, "")

    def commit(self, base: Version, rows: DataFrame, touched: list[int] | None,
               facts: dict | None = None,
               violations: dict[int, int] | None = None) -> Version:
        """Publish a snapshot on top of ``base``: ``rows`` replace the touched
        buckets (None: all), the others are taken over by name.
        ``violations``: rule violations of the new rows by bucket."""
        name = uuid.uuid4().hex
        data = f"data/{name}"
        named = rows.select(*self.schema.names).withColumn(
            BUCKET, self.bucket_of(F.col(self.key), base))
        # Ranges of (bucket, key, order): a large bucket is cut, small ones share a task.
        (named.repartitionByRange(F.col(BUCKET), F.col(self.key), F.col(self.order))
              .sortWithinPartitions(BUCKET, self.key, self.order)
              .write.partitionBy(BUCKET).parquet(f"{self.root}/{data}"))
        written = self._written(data)
        if violations:
            # noted on the first file of the bucket; what has none, on the first of all
            first = {r.bucket: r.file for r in written.groupBy("bucket").agg(
                F.min("file").alias("file")).collect()}
            noted: dict[str, int] = {}
            for bucket, n in violations.items():
                file = first.get(bucket, min(first.values()))
                noted[file] = noted.get(file, 0) + n
            marks = self.spark.createDataFrame(list(noted.items()), "file string, n long")
            written = written.join(F.broadcast(marks), "file", "left").withColumn(
                "violations", F.coalesce("n", F.lit(0).cast("long"))).select(
                *self._manifest_schema.names)
        files = written
        if touched is not None and base.manifest:
            kept = self.manifest(base).filter(~F.col("bucket").isin(touched)
                                              if touched else F.lit(True))
            files = kept.unionByName(written)
        manifest = f"manifests/{name}"
        # one row per file of the table, read as a whole by every reader
        files.coalesce(1).write.parquet(f"{self.root}/{manifest}")
        total = self.spark.read.schema(self._manifest_schema).parquet(
            f"{self.root}/{manifest}").agg(F.sum("rows").alias("rows"),
                                           F.sum("violations").alias("violations")).first()
        version = Version(base.number + 1, base.number, base.buckets, total.rows or 0, manifest,
                          {**(facts or {}), "violations": total.violations or 0,
                           "shape": {"schema": self.schema.json(), "key": self.key,
                                     "order": self.order}})
        try:
            self._publish(version.number, json.dumps(asdict(version)) + "\n")
        except CommitConflict:
            for part in (data, manifest):  # no snapshot names them
                self._fs().delete(self._path(part), True)
            raise
        return version

    def _written(self, data: str) -> DataFrame:
        """Manifest rows of files just written, from two of their columns."""
        folder = f"{self.root}/{data}"
        if not self._fs().exists(self._path(data, "_SUCCESS")) and not any(
                s.isDirectory() for s in self._fs().listStatus(self._path(data))):
            return self.spark.createDataFrame([], self._manifest_schema)
        rows = self.spark.read.schema(T.StructType([
            self.schema[self.key], self.schema[self.order],
            T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
        place = F.col("_metadata.file_path")
        return (rows.select(F.concat(F.lit(f"{data}/"), F.regexp_extract(
                    place, rf"/({BUCKET}=[^/]*/[^/]+)$", 1)).alias("file"), F.col(BUCKET),
                    F.col("_metadata.file_size").alias("size"), self.key, self.order)
                .groupBy("file").agg(
                    F.first(BUCKET).cast("int").alias("bucket"), F.count("*").alias("rows"),
                    F.first("size").alias("bytes"),
                    F.min(self.key).alias("min_key"), F.max(self.key).alias("max_key"),
                    F.min(self.order).alias("min_order"), F.max(self.order).alias("max_order"))
                .withColumn("violations", F.lit(0).cast("long")))


def is_versioned(spark: SparkSession, root: str) -> bool:
    """Whether a folder holds a versioned table with a snapshot."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{COMMITS}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path) and any(s.getPath().getName().isdigit() for s in fs.listStatus(path))
