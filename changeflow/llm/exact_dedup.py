"""Exact dedup by a content sort: equal texts end up next to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import lower_ascii, one_of_twins, partitions, quoted, saved, texts, without

#: What a row weighs besides its text when the load of a group is estimated.
ROW_BYTES = 64
#: Leading bytes of a text that splitters hold.
HEAD = 32


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, repeated``.

    Texts are equal when they are identical after lower-casing A-Z. Spark samples splitters,
    range-partitions the normalised bytes and sorts each range with spilling; the window over
    equal bytes then compares each row with its neighbour in full. Splitters hold the first
    bytes and a hash of the rest, so that what the driver samples stays small whatever the texts.

    A text whose copies outweigh one partition is divided into as many parts as it needs, by a
    hash of the id. Each part finds its own survivor, and a second, equal sort of the parts'
    survivors settles which one stays. There are at most as many such texts as partitions, so
    the list of them has a fixed bound and is broadcast.

    Nulls count as empty texts. ``keep`` takes the ``smallest`` or the ``largest`` id; a null id
    stays only if its group has no other. Of rows with the same id and text one is kept;
    ``repeated`` marks a kept row that has such twins. An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    best, order = (
        (F.min, F.asc_nulls_last("doc_id")) if keep == "smallest" else (F.max, F.desc_nulls_last("doc_id"))
    )
    parts = partitions(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    # Equal after lower-casing A-Z implies equal after full lower-casing: a rough, cheap mark.
    marked = rows.withColumn("mark", F.xxhash64(F.lower("text")))
    weight = F.octet_length("text") + ROW_BYTES
    total = rows.agg(F.sum(weight)).first()[0] or 0
    heavy = (
        marked.groupBy("mark")
        .agg(F.sum(weight).alias("weight"))
        .filter(F.col("weight") * parts > total)
        .select("mark", F.ceil(F.col("weight") * parts / F.lit(max(total, 1))).alias("ways"))
    )
    way = F.when(F.col("ways").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("doc_id"), "ways"))
    dealt = marked.join(F.broadcast(heavy), "mark", "left").select(
        "doc_id", "mark", lower_ascii(F.col("text")).cast("binary").alias("bytes"), way.alias("way")
    )
    key = ("head", "mark", "way")
    ordered = (
        dealt.withColumn("head", F.substring("bytes", 1, HEAD))
        .repartitionByRange(*key)
        .sortWithinPartitions(*key, "bytes", order)
    )
    run = Window.partitionBy(*key, "bytes").orderBy(order)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.row_number().over(run) == 1
    neighbours = ordered.select(
        "doc_id",
        "way",
        "bytes",
        first.alias("first"),
        F.first("doc_id").over(whole).alias("keep_id"),
        F.count(F.lit(1)).over(whole).alias("group_size"),
        (first & F.lead("way").over(run).isNotNull() & F.lead("doc_id").over(run).eqNullSafe(F.col("doc_id"))).alias(
            "repeated"
        ),
    )
    found = saved(
        neighbours.select(
            "doc_id",
            "way",
            "first",
            "keep_id",
            "group_size",
            F.sha2("bytes", 256).alias("text_sha256"),
            F.when(F.col("first") & (F.col("way") > 0), F.col("bytes")).alias("bytes"),
            "repeated",
        ),
        "exact-dedup",
    )
    settled = (
        found.filter("way > 0 and first")
        .repartitionByRange("bytes")
        .groupBy("bytes")
        .agg(
            F.first("text_sha256").alias("text_sha256"),
            best("keep_id").alias("final_id"),
            F.sum("group_size").alias("final_size"),
        )
        .drop("bytes")
    )
    light = found.filter("way = 0").select(
        "doc_id", "keep_id", "group_size", F.col("first").alias("kept"), "text_sha256", "repeated"
    )
    split = (
        found.filter("way > 0")
        .join(settled, "text_sha256")
        .withColumn("kept", F.col("first") & F.col("keep_id").eqNullSafe(F.col("final_id")))
        .select(
            "doc_id",
            F.col("final_id").alias("keep_id"),
            F.col("final_size").alias("group_size"),
            "kept",
            "text_sha256",
            "repeated",
        )
    )
    return light.unionByName(split).withColumn("repeated", F.col("repeated") & F.col("kept"))


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns."""
    groups = saved(
        exact_dedup(docs, id_col, text_col, keep)
        .filter("not kept or repeated")
        .select("doc_id", F.col("text_sha256").alias("key"), "kept"),
        "exact-dedup",
    )
    normal = lower_ascii(F.coalesce(quoted(text_col).cast("string"), F.lit("")))
    key = F.sha2(normal.cast("binary"), 256)
    # A kept row and its twins have the same id and text, so both kinds of rows name it.
    twins = groups.filter("kept")
    dropped = groups.filter("not kept").join(twins.select("doc_id", "key"), ["doc_id", "key"], "left_anti")
    return one_of_twins(without(docs, dropped, key, id_col), twins, key, id_col)
