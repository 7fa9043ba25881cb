"""Preference pairs: the shared beginning once as prompt, two completions with a mask each."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import in_slices, partitions, quoted, saved
from changeflow.llm.tokens import default_tokenizer, encoder_for

#: How a turn is written; the role of a null is empty.
TURN = "<|{role}|>\n{text}\n"
TRAINED_ROLE = "assistant"


def clean_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text`` with one row for a turn; rows without conversation or turn go.

    Of rows with the same number the one with the smallest role, then text, counts.
    """
    empty = F.lit("")
    return (
        turns.select(
            quoted(conv_col).cast("long").alias("conv"),
            quoted(turn_col).cast("long").alias("turn"),
            F.struct(
                F.coalesce(quoted(role_col).cast("string"), empty).alias("role"),
                F.coalesce(quoted(text_col).cast("string"), empty).alias("text"),
            ).alias("said"),
        )
        .filter("conv is not null and turn is not null")
        .groupBy("conv", "turn")
        .agg(F.min("said").alias("said"))
        .select("conv", "turn", "said.role", "said.text")
    )


def preference_turns(
    turns: DataFrame,
    pairs: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``pair_id, part, turn, role, trained, rendered``: one row per turn of a part.

    ``pairs`` has ``pair_id, chosen, rejected``, the ids of two conversations. Turns up to the
    first one that differs in role or text, or that only one side has, are the ``prompt`` and
    appear once; what follows on either side is the part ``chosen`` or ``rejected``. Only turns
    of the assistant in the two completions are ``trained``. Two equal conversations are all
    prompt. A pair with a conversation that has no turns keeps the other side as its completion;
    pairs with a null id are left out, a pair given twice counts once.

    Turns are compared where they stand, by pair and number, so a conversation of any length is
    spread over tasks and never gathered.
    """
    said = clean_turns(turns, conv_col, turn_col, role_col, text_col)
    wanted = pairs.select(
        F.col("pair_id").cast("long"), F.col("chosen").cast("long"), F.col("rejected").cast("long")
    ).dropna()
    wanted = wanted.groupBy("pair_id").agg(F.min(F.struct("chosen", "rejected")).alias("p")).select("pair_id", "p.*")
    sides = wanted.select(
        "pair_id",
        F.explode(
            F.array(
                F.struct(F.lit("chosen").alias("part"), F.col("chosen").alias("conv")),
                F.struct(F.lit("rejected").alias("part"), F.col("rejected").alias("conv")),
            )
        ).alias("s"),
    ).select("pair_id", "s.*")
    spread = sides.join(said, "conv")
    # Both sides of a turn meet in one row of a group; a group has two rows at most.
    met = spread.groupBy("pair_id", "turn").agg(
        *[
            F.max(F.when(F.col("part") == part, F.struct("role", "text"))).alias(part)
            for part in ("chosen", "rejected")
        ]
    )
    differ = met.filter(~F.col("chosen").eqNullSafe(F.col("rejected")))
    ends = differ.groupBy("pair_id").agg(F.min("turn").alias("end"))
    parts = met.join(ends, "pair_id", "left").withColumn(
        "in_prompt", F.col("end").isNull() | (F.col("turn") < F.col("end"))
    )
    said_as = lambda part, source: F.struct(F.lit(part).alias("part"), F.col(source).alias("said"))
    rows = parts.select(
        "pair_id",
        "turn",
        F.explode(
            F.when(F.col("in_prompt"), F.array(said_as("prompt", "chosen"))).otherwise(
                F.array(said_as("chosen", "chosen"), said_as("rejected", "rejected"))
            )
        ).alias("p"),
    ).filter("p.said is not null")
    role, text = F.col("p.said.role"), F.col("p.said.text")
    before, between = TURN.split("{role}")[0], TURN.split("{role}")[1].split("{text}")
    return rows.select(
        "pair_id",
        F.col("p.part").alias("part"),
        "turn",
        role.alias("role"),
        ((F.col("p.part") != "prompt") & (role == TRAINED_ROLE)).alias("trained"),
        F.concat(F.lit(before), role, F.lit(between[0]), text, F.lit(between[1])).alias("rendered"),
    )


def tokenized(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Adds ``n_tokens, ids_crc32, ids, mask`` to rendered turns; the mask is 1 where trained."""
    path = tokenizer or default_tokenizer()

    def encode(batches):
        encoder = encoder_for(path)
        for b in batches:
            found = encoder.encode(b["rendered"].tolist())
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in found]
            b["n_tokens"] = [len(i) for i in ids]
            b["ids_crc32"] = [zlib.crc32(x) for x in found]
            b["ids"] = ids
            b["mask"] = [np.full(len(i), int(t), np.int8) for i, t in zip(ids, b["trained"], strict=True)]
            yield b

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return in_slices(
        rows, encode, f"{kinds}, n_tokens long, ids_crc32 long, ids array<int>, mask array<tinyint>"
    )


def neighbour_pairs(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``pair_id, chosen, rejected``: every conversation as chosen, and its neighbour as rejected.

    Conversations are put in order by a hash of their first turn, then by id, so those that begin
    alike stand together; the neighbour is the next one, and the first one after the last. So any
    conversation is chosen once and rejected once, whatever its id and whoever speaks in it.
    The only conversation of a table has an id without turns as neighbour.

    The order is dealt out by ranges of both, so a first turn that many share is not one task;
    the driver sees one id per range.
    """
    spark = turns.sparkSession
    said = clean_turns(turns, conv_col, turn_col, role_col, text_col)
    heads = said.groupBy("conv").agg(F.min(F.struct("turn", F.xxhash64("role", "text").alias("first"))).alias("h"))
    dealt = saved(
        heads.select("conv", F.col("h.first").alias("first"))
        .repartitionByRange(partitions(spark), "first", "conv")
        .withColumn("part", F.spark_partition_id()),
        "conversations",
    )
    starts = sorted(
        (r["part"], r["start"]["conv"])
        for r in dealt.groupBy("part").agg(F.min(F.struct("first", "conv")).alias("start")).collect()
    )
    follows = [(part, starts[(i + 1) % len(starts)][1]) for i, (part, _) in enumerate(starts)]
    following = spark.createDataFrame(follows, "part int, following long")
    order = Window.partitionBy("part").orderBy("first", "conv")
    paired = dealt.withColumn("after", F.lead("conv").over(order)).join(following, "part")
    other = F.coalesce("after", "following")
    nobody = F.col("conv").bitwiseXOR(F.lit(1).cast("long"))
    return paired.select(
        F.col("conv").alias("pair_id"),
        F.col("conv").alias("chosen"),
        F.when(other == F.col("conv"), nobody).otherwise(other).alias("rejected"),
    )
