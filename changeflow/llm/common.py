"""What several operators share: input columns, written tables, words, hashes, components."""

from __future__ import annotations

import gc
import hashlib
from contextlib import contextmanager
from threading import local

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.sources.workspace import workspace, written
from changeflow.streaming.commits import Folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def quoted(name: str) -> Column:
    """A column by its name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``doc_id`` and ``text``; a null text is empty. Other columns cannot clash below."""
    return docs.select(
        quoted(id_col).cast("long").alias("doc_id"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of ``SLICE`` rows for the job that is started inside.

    Ten thousand texts, the default, are buffers of tens of megabytes in every task, in the JVM and
    in Python.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SLICE))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_MADE = local()


@contextmanager
def noting(folders: list[str]):
    """Add the folders that ``saved`` makes in this thread to ``folders``."""
    before = getattr(_MADE, "folders", None)
    _MADE.folders = folders
    try:
        yield
    finally:
        _MADE.folders = before


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back, so that later jobs start from there."""
    path = workspace(df.sparkSession, purpose)
    if getattr(_MADE, "folders", None) is not None:
        _MADE.folders.append(path)
    with small_batches(df.sparkSession):
        return written(df, path)


def release(docs: DataFrame, folders: list[str]) -> None:
    """Remove ``folders`` that ``docs`` does not read, and shuffle files that nothing refers to.

    Whatever else was derived from the folders cannot be read any more.
    """
    used = {part for f in docs.inputFiles() for part in f.split("/")} if folders else set()
    for path in [f for f in folders if f.rsplit("/", 1)[-1] not in used]:
        Folder(docs.sparkSession, path).remove()
        folders.remove(path)
    # Spark removes the files of a shuffle once the JVM has collected what refers to it.
    gc.collect()
    docs.sparkSession.sparkContext._jvm.System.gc()


#: Rows that a Python function sees at a time.
SLICE = 500


def in_slices(df: DataFrame, function, schema: str) -> DataFrame:
    """Like ``mapInPandas``, with at most ``SLICE`` rows in a frame.

    An Arrow batch may hold ten thousand texts; turning all of them into Python strings at once
    would cost several times their size.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        def parts():
            for b in batches:
                for i in range(0, b.num_rows, SLICE):
                    yield b.slice(i, SLICE).to_pandas(integer_object_nulls=True)

        for out in function(parts()):
            # A long text column comes in several chunks; large frames are handed over in parts.
            yield from pa.Table.from_pandas(out, schema=target, preserve_index=False).to_batches(50_000)
        # The worker may wait for its next task for long; others need the memory.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session has."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_mark(text: Column) -> Column:
    """A 64-bit mark that tells rows with the same id apart by their text."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


#: Words of 64 bits in the bitmap that spares most rows a shuffle: 2**18, 4 MB, whatever the data.
BITMAP_WORDS = 1 << 18


def _bit(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BITMAP_WORDS * 64))


def perhaps_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with ``perhaps``: false where ``doc_id`` is surely not among those of ``ids``.

    The ids are hashed into a bitmap of a fixed size, which is broadcast; rows it rules out need
    not be shuffled for a join. The more ids, the fewer it rules out; results stay the same.
    """
    bit = _bit(F.col("doc_id"))
    words = (
        ids.select((bit / 64).cast("int").alias("word"), F.pmod(bit, F.lit(64)).cast("int").alias("b"))
        .distinct()
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, b))").alias("bits"))
    )
    placed = rows.withColumn("word", (bit / 64).cast("int"))
    has = F.expr(f"shiftright(bits, cast(pmod(pmod(xxhash64(doc_id), {BITMAP_WORDS * 64}), 64) as int)) & 1L") == 1
    found = placed.join(F.broadcast(words), "word", "left")
    return found.withColumn("perhaps", F.coalesce(has, F.lit(False))).drop("word", "bits")


def rows_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` joined with ``ids`` by ``doc_id``; rows without a partner are mostly not moved."""
    return perhaps_in(rows, ids.select("doc_id")).filter("perhaps").drop("perhaps").join(ids, "doc_id")


def text_mark(text: Column) -> Column:
    """A 64-bit mark that tells rows with the same id apart by their text."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _keyed(docs: DataFrame, key: Column, id_col: str) -> DataFrame:
    """All columns in one struct, so that none can clash, with the id and a key beside it."""
    return docs.select(
        F.struct(*map(quoted, docs.columns)).alias("row"), quoted(id_col).cast("long").alias("doc_id"), key.alias("key")
    )


def _rows(keyed: DataFrame, names: list[str]) -> DataFrame:
    return keyed.select(*[F.col("row").getField(c).alias(c) for c in names])


def without(docs: DataFrame, dropped: DataFrame, key: Column, id_col: str) -> DataFrame:
    """Rows of ``docs`` that ``dropped`` (doc_id, key) does not name, with all their columns.

    ``key`` tells texts under one id apart. Only rows whose id may be dropped are moved.
    """
    keyed = perhaps_in(_keyed(docs, key, id_col), dropped)
    gone = dropped.select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct()
    looked_up = keyed.filter("perhaps").join(
        gone, (F.col("key") == F.col("gone_key")) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti"
    )
    return _rows(keyed.filter("not perhaps").unionByName(looked_up), docs.columns)


def one_of_twins(docs: DataFrame, twins: DataFrame, key: Column, id_col: str) -> DataFrame:
    """``docs`` with one row left of each (doc_id, key) in ``twins``; other rows stay."""
    keyed = perhaps_in(_keyed(docs, key, id_col), twins)
    named = twins.select(F.col("doc_id").alias("twin_id"), F.col("key").alias("twin_key")).distinct()
    same = (F.col("key") == F.col("twin_key")) & F.col("doc_id").eqNullSafe(F.col("twin_id"))
    looked_up = keyed.filter("perhaps")
    others = looked_up.join(named, same, "left_anti").select("row")
    single = looked_up.join(named, same, "left_semi").groupBy("doc_id", "key").agg(F.first("row").alias("row"))
    rows = keyed.filter("not perhaps").select("row").unionByName(others).unionByName(single.select("row"))
    return _rows(rows, docs.columns)


def words_of(text: str, fold: bool = False) -> list[bytes]:
    """Words of a text in UTF-8: runs without the six ASCII white space characters.

    ``bytes.split`` splits at just these and ``bytes.lower`` changes A-Z only.
    """
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if fold else raw).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` words, by position."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= factor
        out += hashes[i : i + n]
    return mixed(out)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def components(links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id that each id of ``links`` (a, b) can reach.

    The graph is contracted until no link is left. In each round every node goes over to the
    first of itself and its neighbours, in an order that is drawn anew by a hash; links are
    replaced by those of the nodes gone over to. The last node of a component in that order always
    goes, so it ends; on average a fixed share goes, whatever the shape and numbering, so rounds
    follow the logarithm of the number of nodes. Where each node went is written every round and
    followed back at the end, from the smallest table to the largest; nothing but a count comes
    to the driver.
    """

    def both_ways(pairs: DataFrame) -> DataFrame:
        pairs = pairs.filter("a <> b")
        return saved(
            pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
        )

    def place(node: str, number: int) -> Column:
        return F.struct(F.xxhash64(F.col(node), F.lit(number)).alias("place"), F.col(node).alias("node"))

    edges = both_ways(links.select("a", "b"))
    none = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    moves: list[DataFrame] = []
    while edges.limit(1).count():
        k = len(moves)
        first = edges.groupBy("a").agg(F.min(place("b", k)).alias("near"))
        move = saved(first.select(F.col("a").alias("id"), F.least(place("a", k), "near")["node"].alias("to")), "moves")
        moves.append(move)
        ends = edges.filter("a < b")
        for end in "ab":
            ends = ends.join(move.toDF(end, f"to_{end}"), end)
        edges = both_ways(ends.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")))
    if not moves:
        return none
    reached = moves.pop()
    while moves:
        further = reached.toDF("to", "further")
        reached = saved(
            moves.pop().join(further, "to", "left").select("id", F.coalesce("further", "to").alias("to")), "labels"
        )
    smallest = reached.groupBy("to").agg(F.min("id").alias("component"))
    return reached.join(smallest, "to").select("id", "component")


#: A value is hot if it holds more than this share of all rows, so no more than 4,096 values are.
HOT_SHARE = 4096


def looked_up(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``facts`` (unique by ``key``), whatever share of the rows a key has.

    ``weight`` says how many of the ``total`` rows have the key. The facts of hot keys, of which
    there can be ``HOT_SHARE`` at most, are broadcast and their rows stay where they are; the others
    meet in a shuffle, with less than one part in ``HOT_SHARE`` of the rows under any key.
    """
    hot = facts.filter(F.col(weight) * HOT_SHARE >= total)
    keys = [r[0] for r in hot.select(key).collect()]
    if not keys:
        return rows.join(facts, key)
    cold = rows.filter(~F.col(key).isin(keys)).join(facts.filter(~F.col(key).isin(keys)), key)
    return rows.filter(F.col(key).isin(keys)).join(F.broadcast(hot), key).select(*cold.columns).unionByName(cold)


#: Bits a fingerprint gets in a filter, and what a filter may have at most.
FILTER_BITS, MOST_BITS = 16, 1 << 28


def passes(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Which fingerprints the filter lets through: all that are in it, and a few others."""
    at = prints & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _packed(batches):
    """Words of a filter and where they belong, a batch of rows as two strings of bytes."""
    import pyarrow as pa

    for b in batches:
        at, words = (b.column(c).to_numpy() for c in ("word", "set"))
        yield pa.RecordBatch.from_pydict({"at": [at.astype(np.int32).tobytes()], "words": [words.tobytes()]})


def filter_of(spark: SparkSession, prints: DataFrame):
    """A bitmap of ``prints`` (print), sent to all tasks; at most ``MOST_BITS``.

    Tasks pack its words, so the driver gets 12 bytes a word, 50 MB at most, in some hundred rows.
    """
    bits = 1 << 16
    wanted = prints.count() * FILTER_BITS
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    at = F.col("print").bitwiseAND(F.lit(bits - 1))
    words = prints.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(print & 63L AS int)))").alias("set")
    )
    array = np.zeros(bits // 64, np.uint64)
    for at, held in words.mapInArrow(_packed, "at binary, words binary").collect():
        array[np.frombuffer(at, np.int32)] = np.frombuffer(held, np.uint64)
    return spark.sparkContext.broadcast(array)
