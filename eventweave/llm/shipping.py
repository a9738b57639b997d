"""Make this package importable in the Python workers of the session's executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's sources to the executors, once per application (what
    ``--py-files`` does; harmless where they have them already)."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(_PACKAGE)
        archive = os.path.join(tempfile.mkdtemp(prefix="eventweave-src-"), "eventweave_src.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(_PACKAGE):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, root))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark
