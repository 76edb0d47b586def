"""Read curated trips and bring them to the canonical 26 columns.

All steps are schema work on the driver (no job): renames are one projection,
the missing-column check reads only the schema, and the canonical select lets
the parquet reader skip every column that is not needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import as_table
from tripmart.schemas import CURATED_COLUMNS, CURATED_TRIPS, RAW_TO_CANONICAL


class MissingColumnsError(ValueError):
    """Raised when curated input lacks canonical columns after renaming."""


class AmbiguousColumnsError(ValueError):
    """Raised when two source columns map to the same canonical name."""


def read_curated(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet scan with the schema taken from the files."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def layouts(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files under ``path``, grouped by the schema in their footers.
    Footers are read side by side on the driver, without their row groups; what
    is kept is one line of schema per layout and the names of its files."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    statuses = jvm.java.util.ArrayList()
    for root in [path] if isinstance(path, str) else path:
        root = jvm.org.apache.hadoop.fs.Path(root)
        found = root.getFileSystem(conf).listFiles(root, True)
        while found.hasNext():
            status = found.next()
            parts = status.getPath().toString().split("/")
            # hidden files and folders below the root aren't data
            below = parts[len(root.toString().rstrip("/").split("/")):]
            if status.getLen() and not any(p.startswith(("_", ".")) for p in below):
                statuses.add(status)
    if not statuses.size():
        raise FileNotFoundError(f"no parquet files under {path}")
    groups: dict[str, list[str]] = {}
    footers = jvm.org.apache.parquet.hadoop.ParquetFileReader.readAllFootersInParallel(
        conf, statuses, True)
    for footer in footers:
        schema = footer.getParquetMetadata().getFileMetaData().getSchema().toString()
        groups.setdefault(schema, []).append(footer.getFile().toString())
    return sorted(sorted(files) for files in groups.values())


def canonical_trips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S1, P1-P3 over files of any mix of layouts: each layout is read with its
    own schema, brought to the canonical columns and types, and united."""
    out = None
    for files in layouts(spark, path):
        rows = spark.read.schema(spark.read.parquet(files[0]).schema).parquet(*files)
        try:
            rows = as_table(to_canonical(rows), CURATED_TRIPS)
        except (MissingColumnsError, AmbiguousColumnsError) as e:
            raise type(e)(f"{files[0]} (and {len(files) - 1} files like it): {e}") from None
        out = rows if out is None else out.unionByName(rows)
    return out


def normalize_columns(df: DataFrame, rename_map: dict[str, str] | None = None) -> DataFrame:
    """Rename raw source names to canonical names in one projection.

    Matching is exact (case-sensitive), as in the reference. If a raw name and
    its canonical name are both present (e.g. ``Airport_fee`` and
    ``airport_fee``), the result would hold two columns of one name; this is
    refused with a clear message instead of failing later.
    """
    mapping = RAW_TO_CANONICAL if rename_map is None else rename_map
    targets: dict[str, list[str]] = {}
    for name in df.columns:
        targets.setdefault(mapping.get(name, name), []).append(name)
    clashes = {t: srcs for t, srcs in targets.items() if len(srcs) > 1}
    if clashes:
        detail = ", ".join(f"{t} <- {srcs}" for t, srcs in sorted(clashes.items()))
        raise AmbiguousColumnsError(f"Several source columns map to one name: {detail}")
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def missing_columns(df: DataFrame, expected: list[str] | None = None) -> list[str]:
    """Canonical columns absent from ``df``, in canonical order."""
    present = set(df.columns)
    return [c for c in (expected or CURATED_COLUMNS) if c not in present]


def require_columns(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    missing = missing_columns(df, expected)
    if missing:
        raise MissingColumnsError(
            f"Still missing expected columns after rename: {missing}. "
            f"Available columns: {df.columns}")
    return df


def canonical_select(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """The canonical columns in fixed order; extra columns are dropped."""
    return df.select(*(expected or CURATED_COLUMNS))


def to_canonical(df: DataFrame) -> DataFrame:
    """P1 -> P2 -> P3."""
    return canonical_select(require_columns(normalize_columns(df)))
