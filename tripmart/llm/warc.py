"""Deterministic sharded WARC writer and reader.

The narrow side of the records (id, size, payload digest) decides everything
before any payload moves: which records are revisits, and, from cumulated
payload sizes along (id, payload digest), where shards begin. Payloads are then
dealt out by shard, sorted, and written as one gzip member a record; files roll
at a compressed size. A shard holds its size and a payload at most, whatever the
ids, save that rows equal in id and payload go to one shard. The same input gives the same bytes under the
same names.

Tasks write under names of their own in ``_temporary``; a second job moves the
files that the successful attempts reported to their final names, and the
manifest, written last, lists what the archive consists of. A lost executor
costs a retry and leaves nothing behind that a reader would see.

Defined results: a NULL html is an empty payload, a NULL url an empty URI; rows
that share a page_id are separate records (``nth`` tells them apart); a NULL
page_id is the smallest.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.components import join_counted
from tripmart.llm.shipping import ship_package
from tripmart.session import cut_lineage, cut_observed

#: Payload of a shard, and compressed size at which a shard's file rolls.
SHARD_BYTES = 16 << 20
ROLL_BYTES = 2 << 20
#: Shorter payloads are always written in full.
LEAST_REVISIT = 1000
WARC_DATE = "2024-01-01T00:00:00Z"
#: Beyond this many shards, they hold more payload each. Bounds what is broadcast.
MAX_SHARDS = 1 << 20
#: Records of an ordered range of the plan.
ROWS_PER_RANGE = 250_000
# Fixed value: the profile of a revisit with an identical payload.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "name string, temporary string, records long, bytes long, sha1 string"


def _open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


# --- records -----------------------------------------------------------------


def _record_id(page_id: int | None, nth: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{nth}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.strip("<>").split(":")[2]
    return int(number) if number else None


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def format_record(row: dict, date: str = WARC_DATE) -> bytes:
    """One WARC record, with headers and digests made anew from the row. The
    HTTP header of a revisit still gives the length of the full payload."""
    payload = row["payload"] or b""
    uri = "".join(c for c in row["url"] or "" if c not in "\r\n")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    revisit = row["refers_nth"] is not None
    block = http if revisit else http + payload
    digest = "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(row['page_id'], row['nth'])}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {uri}"]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}",
                 f"WARC-Refers-To: {_record_id(row['refers_to'], row['refers_nth'])}"]
    head += [f"WARC-Payload-Digest: {digest}", f"WARC-Block-Digest: {_digest(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # 31: gzip, without name or time
    return packer.compress(data) + packer.flush()


def read_members(stream):
    """The records of an archive, one gzip member at a time."""
    packed = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            packed = packed or stream.read(1 << 20)
            if not packed:
                if parts:
                    raise ValueError("an archive ends inside a record")
                return
            parts.append(unpacker.decompress(packed))
            packed = unpacker.unused_data
        yield b"".join(parts)


def parse_record(record: bytes) -> dict:
    """Fields of a record; its digests are checked against its content."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if _digest(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"wrong block digest in {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind = fields["WARC-Type"]
    if kind == "response" and (_digest(payload) != fields["WARC-Payload-Digest"]
                               or len(payload) != size):
        raise ValueError(f"wrong payload digest in {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "payload_bytes": size,
            "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(),
            "record_type": kind, "refers_to": _page_of(refers) if refers else None,
            "url": fields["WARC-Target-URI"], "payload": payload}


# --- plan --------------------------------------------------------------------


def _payload() -> Column:
    return F.coalesce(F.col("html").cast("binary"), F.lit(b""))


def _page_rows(pages: DataFrame, *more: Column) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.sha1(_payload()).alias("payload_digest"), *more)


def _shard_key() -> tuple[Column, Column]:
    """What a shard begins with: the page_id and 60 bits of the payload digest."""
    return (F.coalesce("page_id", F.lit(-1 << 63)),
            F.conv(F.substring("payload_digest", 1, 15), 16, 10).cast("long"))


def _find_shard(pages: np.ndarray, digests: np.ndarray, first_page: np.ndarray,
                first_digest: np.ndarray) -> np.ndarray:
    """Number of the last shard that begins at or before each key; the first
    keys are sorted."""
    low = np.searchsorted(first_page, pages, "left")
    high = np.searchsorted(first_page, pages, "right")
    found = low - 1
    for page in np.unique(pages[high > low]):  # shards begin within this page_id
        rows = np.flatnonzero(pages == page)
        a, b = low[rows[0]], high[rows[0]]
        found[rows] = a - 1 + np.searchsorted(first_digest[a:b], digests[rows], "right")
    return np.maximum(found, 0)


@dataclass
class _Shards:
    """First key of every shard, sorted: at most MAX_SHARDS pairs of longs."""

    pages: np.ndarray
    digests: np.ndarray

    def with_shard(self, rows: DataFrame) -> DataFrame:
        firsts = rows.sparkSession.sparkContext.broadcast((self.pages, self.digests))

        def shard(page: pd.Series, digest: pd.Series) -> pd.Series:
            return pd.Series(_find_shard(page.to_numpy(), digest.to_numpy(), *firsts.value))

        return rows.withColumn("shard", F.pandas_udf(shard, "int")(*_shard_key()))


def plan_records(pages: DataFrame, shard_bytes: int) -> tuple[DataFrame, _Shards]:
    """The plan, a row per (page_id, payload, url): payload_bytes, ``times`` (equal
    rows, which are records ``nth``, nth + 1, ...), refers_to and refers_nth (the
    record that holds the payload, if revisits are allowed) and ``holds`` (the
    last of these records is that one); and the shards.

    Records lie in order of (page_id, digest, url), cut into ranges; payload
    and rows before a record are those of its range plus those of earlier
    ranges. So neither a page_id nor a payload that a third of the rows share is
    one window.
    """
    spark, order = pages.sparkSession, ["page_id", "payload_digest", "url"]
    rows = _page_rows(pages, F.octet_length(_payload()).cast("long").alias("payload_bytes"))
    rows, seen = cut_observed(
        rows.groupBy(*order).agg(F.max("payload_bytes").alias("payload_bytes"),
                                 F.count(F.lit(1)).alias("times")), "warc_groups",
        [F.count(F.lit(1)).alias("n"), F.sum(F.col("payload_bytes") * F.col("times")).alias("size")])
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-seen["n"] // ROWS_PER_RANGE))
    rows = cut_lineage(rows.repartitionByRange(ranges, *order)
                       .withColumn("range", F.spark_partition_id()), "warc_ranges")
    size = F.sum(F.col("payload_bytes") * F.col("times"))
    earlier = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    # at most a row per range, and a row per range that begins inside a page_id
    sizes = rows.groupBy("range").agg(size.alias("size")).select(
        "range", F.coalesce(F.sum("size").over(Window.orderBy("range").rowsBetween(*earlier)), zero)
        .alias("size_before"))
    begun = rows.groupBy("page_id", "range").agg(F.sum("times").alias("n")).select(
        "range", F.col("page_id").alias("begun_id"),
        F.sum("n").over(Window.partitionBy("page_id").orderBy("range").rowsBetween(*earlier))
        .alias("n_before")).filter("n_before > 0")
    rows = rows.join(F.broadcast(sizes), "range").join(F.broadcast(begun), "range", "left")
    in_range = Window.partitionBy("range").orderBy(*order).rowsBetween(*earlier)
    in_page = (Window.partitionBy("range", "page_id").orderBy("payload_digest", "url")
               .rowsBetween(*earlier))
    of_page = F.when(F.col("page_id").eqNullSafe(F.col("begun_id")), F.col("n_before"))
    rows = cut_lineage(rows.select(
        *order, "payload_bytes", "times",
        (F.col("size_before") + F.coalesce(size.over(in_range), zero)).alias("before"),
        (F.coalesce(of_page, zero) + F.coalesce(F.sum("times").over(in_page), zero)).alias("nth")),
        "warc_records")
    # --- shards: the first key at or after every multiple of their size
    step = max(shard_bytes, -(-(seen["size"] or 0) // MAX_SHARDS))
    page, digest = _shard_key()
    firsts = (rows.groupBy(F.floor(F.col("before") / F.lit(step)).alias("k"))
              .agg(F.min(F.struct(page.alias("page"), digest.alias("digest"))).alias("first"))
              .select("first.*").distinct().toPandas().sort_values(["page", "digest"]))
    shards = _Shards(firsts["page"].to_numpy("int64"), firsts["digest"].to_numpy("int64"))
    # --- revisits: of equal long payloads the last record holds the payload
    long, short = rows.filter(F.col("payload_bytes") >= LEAST_REVISIT), rows.filter(
        F.col("payload_bytes") < LEAST_REVISIT)
    end = F.col("nth") + F.col("times") - 1
    held = long.groupBy("payload_digest").agg(
        F.max(F.struct("page_id", end.alias("nth"))).alias("last"), F.count(F.lit(1)).alias("n"))
    long = join_counted(long, held, "payload_digest", seen["n"])
    holds = F.col("page_id").eqNullSafe(F.col("last.page_id")) & (end == F.col("last.nth"))
    columns = [*order, "payload_bytes", "times", "nth"]
    plan = long.select(*columns, F.col("last.page_id").alias("refers_to"),
                       F.col("last.nth").alias("refers_nth"), holds.alias("holds"))
    return plan.unionByName(short.select(*columns), allowMissingColumns=True), shards


# --- writing and reading -----------------------------------------------------


class _Shard:
    """Files of one shard under way."""

    def __init__(self, target: str, shard: int, roll_bytes: int):
        self.fs, self.root = _open_fs(target)
        self.shard, self.roll, self.seq = shard, roll_bytes, 0
        self.stream = None

    def add(self, member: bytes):
        if self.stream is None:
            context = TaskContext.get()
            self.name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.temporary = f"_temporary/{context.taskAttemptId()}-{self.name}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.stream = self.fs.open_output_stream(f"{self.root}/{self.temporary}",
                                                     compression=None)
            self.records, self.size, self.sha1 = 0, 0, hashlib.sha1()
        self.stream.write(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        self.sha1.update(member)
        return self.close() if self.size >= self.roll else []

    def close(self):
        if self.stream is None:
            return []
        self.stream.close()
        self.stream, self.seq = None, self.seq + 1
        return [(self.name, self.temporary, self.records, self.size, self.sha1.hexdigest())]


def _manifest_batch(rows) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [f.split()[0] for f in _MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def write_warc(pages: DataFrame, target: str, shard_bytes: int = SHARD_BYTES,
               roll_bytes: int = ROLL_BYTES, date: str = WARC_DATE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as an archive in the folder
    ``target`` (a URI that all executors reach); returns its manifest."""
    spark = pages.sparkSession
    ship_package(spark)
    plan, shards = plan_records(pages, shard_bytes)
    rows = _page_rows(pages, _payload().alias("payload"))
    # Payloads move once: the plan comes to them, each decision just before the
    # records it is about.
    both = shards.with_shard(plan.withColumn("kind", F.lit(0)).unionByName(
        rows.withColumn("kind", F.lit(1)), allowMissingColumns=True))
    order = ["shard", "page_id", "payload_digest", "url", "kind"]
    both = (both.repartitionById(max(1, len(shards.pages)), "shard").sortWithinPartitions(*order)
            .select(*order, "payload", "payload_bytes", "times", "nth", "refers_to", "refers_nth",
                    "holds"))

    def write(batches):
        now, decided, done_rows = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    decided, done_rows = row, 0
                    continue
                done_rows += 1
                row = decided | {"payload": row["payload"], "nth": decided["nth"] + done_rows - 1}
                if row["holds"] and done_rows == row["times"]:
                    row["refers_to"] = row["refers_nth"] = None
                if now is None or now.shard != row["shard"]:
                    if now is not None and (done := now.close()):
                        yield _manifest_batch(done)
                    now = _Shard(target, row["shard"], roll_bytes)
                if done := now.add(_gzip_member(format_record(row, date))):
                    yield _manifest_batch(done)
        if now is not None and (done := now.close()):
            yield _manifest_batch(done)

    def commit(batches):
        files, root = _open_fs(target)
        for batch in batches:
            for row in batch.to_pylist():
                end = f"{root}/{row['name']}"
                # a retry of this task finds the file moved already
                if files.get_file_info(f"{root}/{row['temporary']}").type != fs.FileType.NotFound:
                    files.move(f"{root}/{row['temporary']}", end)
                if files.get_file_info(end).size != row["bytes"]:
                    raise OSError(f"{end} is not the file that was written")
            yield batch

    written = cut_lineage(both.mapInArrow(write, _MANIFEST), "warc_written")
    written.mapInArrow(commit, _MANIFEST).write.parquet(f"{target}/manifest")
    # what lost attempts left behind
    left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/_temporary")
    left.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(left, True)
    return spark.read.parquet(f"{target}/manifest")


def read_warc(spark: SparkSession, target: str, with_payload: bool = False) -> DataFrame:
    """The records of an archive, from the files that its manifest lists: page_id,
    payload_bytes, payload_digest, record_type, refers_to[, url, payload]."""
    ship_package(spark)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if with_payload:
        names, schema = [*names, "url", "payload"], schema + ", url string, payload binary"
        kinds += [pa.string(), pa.binary()]

    def read(batches):
        files, root = _open_fs(target)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in read_members(io.BufferedReader(stream, 1 << 20)):
                        row = parse_record(record)
                        rows.append([row[n] for n in names])
                        size += len(record) if with_payload else 200
                        if size >= 1 << 24:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    manifest = spark.read.parquet(f"{target}/manifest").select("name", "bytes")
    n = max(1, manifest.count())
    return manifest.repartition(min(n, 100_000), "name").mapInArrow(read, schema)
