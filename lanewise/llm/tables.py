"""Reading the given tables, and settings the operators share."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of every operator here: runs of anything but ASCII white space. bytes.split()
# cuts UTF-8 text at exactly these six characters.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

BATCH_ROWS, BATCH_BYTES = "2000", "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=8)
def _ship(application: str) -> str:
    """Zip this package on the driver; Spark hands the file to its executors."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="lanewise-"), "lanewise.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                out.write(file, os.path.relpath(file, os.path.dirname(package)))
    return path


def python_tasks(spark: SparkSession) -> None:
    """Before Python tasks: give the workers this package, and bound what one Arrow batch
    hands to them, by rows and by bytes."""
    context = spark.sparkContext
    path = _ship(context.applicationId)
    if not any(os.path.basename(path) in known for known in context.listFiles):
        context.addPyFile(path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    An expression that a lambda function refers to is computed again for every element;
    as the variable of an outer lambda function it is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def share_of(total: int, size: int) -> int:
    """How many parts of about ``size`` hold ``total``; at least one."""
    return max(1, -(-int(total or 0) // size))


def per_worker(build: Callable) -> Callable:
    """Keep what ``build`` returns for as long as the Python worker lives."""
    return functools.lru_cache(maxsize=4)(build)


class Memory(dict):
    """Results by key, made on demand; at most two generations of ``limit`` entries."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
