"""Files that land below ``<root>/date=D``, as a stream.

Spark's file stream holds a listing of all files on the driver, and in a batch one entry for each of its files.  Here
tasks list the folders, and what the log does not have yet is written to it; Spark's file stream follows the
log, whose files hold many paths each.  A file counts once, however often it is written again.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import make_dir, scratch, written
from .landed import list_files
from .store import or_empty

LOG = logging.getLogger(__name__)
_LOGGED = "path string, date string"


def note_arrivals(spark: SparkSession, root: str, log: str, most: int | None = None) -> int:
    """Write the files that landed since to the log, ``most`` in a file of it or about as many; returns how many."""
    with scratch(spark):
        seen = or_empty(spark, lambda: spark.read.schema(_LOGGED).parquet(log), _LOGGED)
        # a listing that was broken off left whole files of the log, and the rest is found now
        found = list_files(spark, root).select("path", "date").join(seen.select("path"), "path", "left_anti")
        found = written(found, "arrivals")
        n = found.count()
        if n:
            parts = -(-n // most) if most else 1 + n // 100_000
            found = found.repartitionByRange(parts, "path") if parts > 1 else found.coalesce(1)
            found.write.mode("append").option("maxRecordsPerFile", most or 0).parquet(log)
        return n


def logged_arrivals(spark: SparkSession, log: str, most: int | None = None) -> DataFrame:
    """The stream of ``path, date`` in the log, a file of it at a time or with no ``most`` all there are."""
    make_dir(spark, log)
    limit = {} if most is None else {"maxFilesPerTrigger": 1}
    return spark.readStream.schema(_LOGGED).options(**limit).parquet(log)


def keep_noting(query: StreamingQuery, note: Callable[[], int], seconds: float) -> None:
    """Look for arrivals every so many seconds as long as the stream runs."""

    def watch() -> None:
        while not query.awaitTermination(max(seconds, 1)):
            try:
                note()
            except Exception:  # what landed is found the next time
                LOG.exception("payload folders could not be listed")

    threading.Thread(target=watch, name="arrivals", daemon=True).start()
