"""Makes this package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession

_ARCHIVE = "tripmart_package.zip"


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the workers of this session, once, as
    ``spark-submit --py-files`` would."""
    sc = spark.sparkContext
    if any(f.endswith("/" + _ARCHIVE) for f in sc.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    # A folder of the driver's own, which Spark removes with the session; its
    # file server sends the archive to the executors.
    folder = os.path.join(SparkFiles.getRootDirectory(), "shipped")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, _ARCHIVE)
    with open(path, "wb") as f:
        f.write(data.getvalue())
    sc.addPyFile(path)
