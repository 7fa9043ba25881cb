"""Change logs as files or Kafka topics, bounded or streaming, in one set of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.model import LOG_SCHEMA

# In a file log the topic is the folder.
_RECORD_SCHEMA = LOG_SCHEMA.removeprefix("topic string, ")
_TORN = "_torn"
# No file is older than the newest one by so much.
FOR_EVER = "36500d"


def write_log(
    records: DataFrame, path: str, mode: str = "errorifexists", file_format: str = "json"
) -> None:
    """One folder per topic, so that a reader of one topic lists only its files.

    JSON lines are what other tools exchange; for a log that only Spark reads, ``parquet``
    spares escaping and parsing every value once more.
    """
    columns = ["topic", "partition", "offset", "timestamp", "key", "value"]
    writer = records.select(*columns).write.mode(mode).partitionBy("topic")
    writer.format(file_format).save(path)


def _whole_or_torn(records: DataFrame) -> DataFrame:
    """Records of a JSON log; a line that is none keeps its text as value and nothing else."""
    torn = F.col(_TORN).isNotNull()
    fields = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    kept = [c if c == "topic" else F.when(~torn, F.col(c)).alias(c) for c in fields[:-1]]
    return records.select(*kept, F.coalesce(_TORN, "value").alias("value"), torn.alias("torn"))


def _json(reader):
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _TORN)


def read_log(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Bounded replay of a file log from the beginning.

    In a JSON log a line may be torn by a writer that died. Column ``torn`` marks it, its text
    is the value and its position is unknown.
    """
    if file_format != "json":
        return spark.read.schema(LOG_SCHEMA).format(file_format).load(path)
    lines = _json(spark.read).schema(f"{LOG_SCHEMA}, {_TORN} string").json(path)
    return _whole_or_torn(lines)


def stream_log(
    spark: SparkSession,
    path: str,
    topic: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    file_format: str = "json",
    max_file_age: str = FOR_EVER,
    **options: str,
) -> DataFrame:
    """Subscribe to one topic of a file log; torn lines as in ``read_log``.

    Spark leaves out files that are older, by their time stamp, than the newest one by more than
    ``max_file_age``. Backfills and copies that keep time stamps are such files, so by default
    none is too old. Spark then remembers the name of every file it has read, some hundred bytes
    each in the driver and the checkpoint; to keep that small have read files moved away or
    deleted, with ``cleanSource`` and ``sourceArchiveDir`` among the ``options``, or shorten the age
    where files are sure to arrive in time.
    """
    reader = spark.readStream.option("maxFileAge", max_file_age).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    folder = f"{path}/topic={topic}"
    if file_format != "json":
        records = reader.schema(_RECORD_SCHEMA).format(file_format).load(folder)
        return records.select(F.lit(topic).alias("topic"), "*")
    records = _json(reader).schema(f"{_RECORD_SCHEMA}, {_TORN} string").json(folder)
    return _whole_or_torn(records.select(F.lit(topic).alias("topic"), "*"))


def stream_topics(
    spark: SparkSession,
    path: str,
    pattern: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    file_format: str = "json",
    max_file_age: str = FOR_EVER,
    **options: str,
) -> DataFrame:
    """Subscribe to all topics of a file log whose whole name matches a regular expression.

    One source reads them all, and topics that appear later are among them. The topic is the
    folder of a file, so files of other topics are not read. Options as in ``stream_log``.
    """
    reader = spark.readStream.option("maxFileAge", max_file_age).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    wanted = F.col("topic").rlike(f"^(?:{pattern})$")
    if file_format != "json":
        return reader.schema(LOG_SCHEMA).format(file_format).load(path).where(wanted)
    records = _json(reader).schema(f"{LOG_SCHEMA}, {_TORN} string").json(path)
    return _whole_or_torn(records.where(wanted))


def kafka_options(
    servers: str,
    topics: list[str] | None = None,
    pattern: str | None = None,
    start: str = "earliest",
    max_offsets: int | None = None,
    more: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for listed topics or a name pattern.

    ``more`` takes any other option of the source, such as ``kafka.security.protocol``,
    ``minPartitions`` or ``failOnDataLoss``; it cannot replace those that have a parameter.

    The default start is ``earliest``, so that a snapshot published before the first run is
    not missed. Where to resume is kept in the checkpoint of the query.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": start}
    if topics is not None:
        options["subscribe"] = ",".join(topics)
    else:
        options["subscribePattern"] = pattern
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return {**(more or {}), **options}


def _as_text(records: DataFrame) -> DataFrame:
    return records.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string"),
        F.col("value").cast("string"),
    )


def read_kafka(spark: SparkSession, **options) -> DataFrame:
    """Bounded replay of Kafka topics; needs Spark's Kafka package on the class path."""
    return _as_text(spark.read.format("kafka").options(**kafka_options(**options)).load())


def stream_kafka(spark: SparkSession, **options) -> DataFrame:
    """Subscribe to Kafka topics; needs Spark's Kafka package on the class path."""
    return _as_text(spark.readStream.format("kafka").options(**kafka_options(**options)).load())


def write_kafka(events: DataFrame, servers: str, more: dict[str, str] | None = None) -> None:
    """Publish captured events ``topic, key, value``; ``more`` as in ``kafka_options``."""
    options = {**(more or {}), "kafka.bootstrap.servers": servers}
    events.select("topic", "key", "value").write.format("kafka").options(**options).save()
