"""Session settings the transforms rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Runtime settings only: each can be set on a session somebody else started.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # JSON objects may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# What one task reads at most, of files and of a shuffle.  Parsing, exploding and hashing make many times that
# of it in memory, so a task's share must not grow with the input; Spark's defaults are 128 and 64 MB.
TASK_CONF = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
}
#: Partitions a shuffle begins with; Spark joins small ones up to the size above.
INITIAL_PARTITIONS = 1000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
#: The session's own values of what ``bound_tasks`` sets.
_own: dict[str, str | None] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the transforms rely on to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"([0-9]+)\s*([bkmgt]?)b?", text.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def bound_tasks(spark: SparkSession) -> None:
    """Have tasks hold about as much whatever the size of the tables; smaller shares are left as they are."""
    for key, most in TASK_CONF.items():
        now = spark.conf.get(key)
        if _bytes(now) > most:
            _own.setdefault(key, now)
            spark.conf.set(key, str(most))
    now = spark.conf.get(_INITIAL, None)
    if int(now or spark.conf.get("spark.sql.shuffle.partitions")) < INITIAL_PARTITIONS:
        _own.setdefault(_INITIAL, now)
        spark.conf.set(_INITIAL, str(INITIAL_PARTITIONS))


def unbound_tasks(spark: SparkSession) -> None:
    """The session's own settings again."""
    while _own:
        key, value = _own.popitem()
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def local_session(cores: int | str = 8, app: str = "stackroom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SCRATCH_NAME = re.compile(r"/[a-z-]+-[0-9a-f]{32}$")


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="stackroom-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a local session
    without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_scratch(path: str) -> None:
    """Remove a folder made by ``scratch_dir`` once what was built from it is written."""
    from pyarrow import fs

    if _SCRATCH_NAME.search(path) is None:
        raise ValueError(f"not a scratch folder: {path}")
    local = "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path
    if "://" in local:
        filesystem, local = fs.FileSystem.from_uri(local)
    else:
        filesystem = fs.LocalFileSystem()
    filesystem.delete_dir(local)


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    fields = StructType.fromDDL(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def small_frame(spark: SparkSession, schema: str, **columns: list) -> DataFrame:
    """A few rows of planning data (file names, sizes), handed over by Arrow."""
    fields = StructType.fromDDL(schema)
    if not any(columns.values()):
        return empty_frame(spark, schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    table = pa.table({f.name: columns[f.name] for f in fields}, schema=to_arrow_schema(fields))
    return spark.createDataFrame(table, fields)
