"""Written intermediate tables with an exact row count.

An aggregate is written once to the cluster's shared checkpoint folder and read back. That cuts the
lineage, survives lost executors, and gives the exact size a join needs to choose between broadcast
and shuffle.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_dirs: dict[str, str] = {}
_beside = threading.local()

#: A table of no more rows stays as it was written; Spark ML looks at all of so many rows for its split candidates.
SMALL_ROWS = 10_000
#: Rows that are worth a part of their own, up to two parts a core, and the bytes a part may take. Jobs side by side share the cores.
PART_ROWS = 20_000
PART_BYTES = 128 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dirs.setdefault(context.applicationId, tempfile.mkdtemp(prefix="tallywind-"))


class Stored:
    """A table whose rows and bytes of text are counted exactly, once, when its size is first asked for."""

    def __init__(self, df: DataFrame, size: tuple[int, int] | None = None):
        self.df = df
        self._size = size

    def _measure(self) -> tuple[int, int]:
        if self._size is None:
            texts = [f.name for f in self.df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
            sums = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in texts]
            rows, *lengths = self.df.agg(F.count(F.lit(1)), *sums).first() if texts else (self.df.count(),)
            self._size = rows, sum(lengths)
        return self._size

    @property
    def rows(self) -> int:
        return self._measure()[0]

    @property
    def text_bytes(self) -> int:
        return self._measure()[1]

    @property
    def bytes(self) -> int:
        """Bytes of the table in a broadcast: fixed widths, and texts as long as they are."""
        rows, texts = self._measure()
        return texts + rows * sum(_width(field.dataType) for field in self.df.schema.fields)


def store(df: DataFrame) -> Stored:
    """Write ``df`` once and return the written table; counting it only reads the file footers."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path))


def dealt(stored: Stored, width: int) -> DataFrame:
    """The rows of a table that is passed over many times, in even parts by their own numbers; ``width`` is the bytes of a row.

    Files are read in parts by their compressed sizes, which are uneven, a few more than there are cores, and many times
    as large once they are decoded. Small tables stay as they are. Where several such tables are passed over side by side, each
    has its share of the cores: thousands of short passes would else be spent on handing out tasks.
    """
    rows = stored.rows
    if rows <= SMALL_ROWS:
        return stored.df
    cores = stored.df.sparkSession.sparkContext.defaultParallelism
    spread = min(-(-2 * cores // jobs_beside()), -(-rows // PART_ROWS))
    parts = max(spread, -(-rows * width // PART_BYTES))
    return stored.df.withColumn("_at", F.monotonically_increasing_id()).repartition(parts, "_at").drop("_at")


def store_all(*frames: DataFrame | Stored) -> list[Stored]:
    """Store and count several independent tables, their jobs running side by side."""

    def ready(frame: DataFrame | Stored) -> Stored:
        stored = frame if isinstance(frame, Stored) else store(frame)
        stored.rows  # noqa: B018 - counted here, so that the counts run side by side too
        return stored

    return side_by_side(ready, frames)


def side_by_side(fn: Callable, items: Sequence) -> list:
    """``fn`` of every item, in threads, so that Spark runs the jobs it starts at the same time."""
    if len(items) == 1:
        return [fn(items[0])]
    threads = max(1, min(8, len(items)))
    jobs = threads * jobs_beside()

    def one(item):
        _beside.jobs = jobs
        return fn(item)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(one, items))


def jobs_beside() -> int:
    """How many functions run side by side where this is called."""
    return getattr(_beside, "jobs", 1)


def _width(kind: T.DataType) -> int:
    """Bytes a value takes in a broadcast row beside the bytes of a text; lists and vectors at a generous fixed size."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 16
    if isinstance(kind, T.StructType):
        return 8 + sum(_width(field.dataType) for field in kind.fields)
    return 8 if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) else 64
