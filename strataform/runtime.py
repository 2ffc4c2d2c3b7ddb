"""Session helpers: configuration, shared checkpoints and joins that survive hot keys.

Intermediate results that cut a lineage are written as Parquet tables under the
folder the cluster names in ``spark.checkpoint.dir``, so a lost executor never
loses them.  Only where that setting is absent (tests, notebooks on one machine)
is a folder of our own chosen.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its measured size stays under this bound.
BROADCAST_LIMIT_BYTES = 32 << 20

#: A key is hot when it holds more than this share of the rows; at most
#: ``1 / HOT_SHARE`` keys can, which bounds what is broadcast for them.
HOT_SHARE = 0.005


def local_session(cores: str = "8", app: str = "strataform", shuffle_partitions: int = 8) -> SparkSession:
    """A session for one machine with the settings the engine expects."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Reads ``spark.checkpoint.dir``; where unset, a temporary folder is used on a
    local master and any other master is refused, because a machine-local folder
    would not outlive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = tempfile.mkdtemp(prefix="strataform-")
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


class Stored:
    """A written intermediate table; ``drop`` removes its files.

    ``rows`` is how many were written, if they were counted on the way; ``by``
    names a column whose values are to lie in files of their own.
    """

    _open: list[Stored] = []

    def __init__(self, df: DataFrame, name: str, counted: bool = False, by: str | None = None):
        self.spark = df.sparkSession
        self.path = f"{checkpoint_root(self.spark)}/strataform/{name}-{uuid.uuid4().hex}"
        seen = Observation() if counted else None
        (df.observe(seen, F.count(F.lit(1)).alias("rows")) if seen else df).write.parquet(self.path, partitionBy=by)
        self.rows: int = seen.get["rows"] if seen else -1
        self.schema = df.schema
        Stored._open.append(self)

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _folder(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def size_bytes(self) -> int:
        files, path = self._folder()
        return files.getContentSummary(path).getLength()

    def drop(self) -> None:
        files, path = self._folder()
        files.delete(path, True)
        if self in Stored._open:
            Stored._open.remove(self)


@atexit.register
def _drop_open() -> None:
    for stored in list(Stored._open):
        try:
            stored.drop()
        except Exception:  # the session is gone already
            break


def store(df: DataFrame, name: str, counted: bool = False, by: str | None = None) -> Stored:
    """Write ``df`` to the shared folder and cut its lineage there."""
    return Stored(df, name, counted, by)


@contextmanager
def scratch() -> Iterator[Callable[[Stored], Stored]]:
    """Drops on leaving every table stored inside, but for those handed to what it yields.

    What is kept must be written tables or rows read from them alone.
    """
    before, kept = set(map(id, Stored._open)), set()

    def keep(stored: Stored) -> Stored:
        kept.add(id(stored))
        return stored

    yield keep
    for stored in list(Stored._open):
        if id(stored) not in before and id(stored) not in kept:
            stored.drop()


@contextmanager
def tasks_apart(spark: SparkSession) -> Iterator[None]:
    """Inside, a union keeps the tasks of its parts; Spark would run parts of one task each as one task together."""
    name = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


#: A table that comes in too few pieces is spread over the cores only up to this size.
SPREAD_LIMIT_BYTES = 128 << 20


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a small table over all cores, where it comes in fewer pieces than there are cores.

    A single small file would otherwise keep one core busy.  The plan's estimate
    of its size bounds what is shuffled; larger tables are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SPREAD_LIMIT_BYTES:
        return rows
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def hot_rows(counted: DataFrame, count: str, total: int) -> DataFrame:
    """Rows of a table with one row per key whose key holds over ``HOT_SHARE`` of ``total``.

    The counts sum to ``total``, so at most ``1 / HOT_SHARE`` rows come out.
    """
    return counted.where(F.col(count) > F.lit(max(1.0, total * HOT_SHARE)))


def lookup_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows of ``left`` to a table with one row per key, some keys being hot.

    ``hot`` holds the (boundedly many) rows of ``right`` with hot keys: their
    share of ``left`` is joined by broadcast and never shuffled, the rest by an
    ordinary shuffled join.
    """
    bounded = F.broadcast(hot.withColumnRenamed(right_key, left_key))
    rest = right.withColumnRenamed(right_key, left_key)
    warm = left.join(bounded, left_key, "inner")
    cold = left.join(F.broadcast(hot.select(F.col(right_key).alias(left_key))), left_key, "left_anti")
    return warm.unionByName(cold.join(rest, left_key, how))


def trimmed(col: Column) -> Column:
    """Strip blanks of every kind, no-break spaces included, from both ends."""
    return F.regexp_replace(col, r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$", "")
