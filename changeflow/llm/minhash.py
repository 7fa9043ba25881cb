"""Near duplicates by MinHash: banded candidates, pruned by batches of signatures, then whole sets."""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import (
    components,
    gram_hashes,
    in_slices,
    looked_up,
    rows_of,
    saved,
    text_mark,
    texts,
    word_hashes,
    words_of,
)

#: A band is this many minima, and a signature this many bands. Two sets of similarity 0.85 agree
#: in no band with probability (1 - 0.85**4)**32, less than 1 in 10**10.
ROWS, BANDS = 4, 32
#: Bands compared before the posterior is looked at again.
BATCH = 8
#: Probability that the similarity of a pruned pair reaches the threshold after all.
MISS = 1e-7
#: Words of 64 bits that say which of so many cells hold an odd number of shingles.
SKETCH = 4
#: Members that are tried with all others of a bucket before any pairs are formed.
PIVOTS = 2

_SEEDS = np.random.RandomState(13).randint(0, 2**63, (2, ROWS * BANDS), np.int64).astype(np.uint64)
_FACTORS, _SHIFTS = _SEEDS[0] | np.uint64(1), _SEEDS[1]
#: The minima of a band in one number: three of 15 bits, and one of 14 at the top, below the sign.
_LANES = np.array([0x7FFF, 0x7FFF, 0x7FFF, 0x3FFF], np.uint64)
#: Added to the difference of two bands, it sets the bits of ``_FLAGS`` where lanes differ.
_CARRY, _FLAGS = 0x3FFF7FFF7FFF7FFF, 0x4000800080008000


def shingles(text: str, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; fewer words than ``size`` are one."""
    words = words_of(text, fold=True)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b"\x20".join(words), seed=1)], np.uint64)
    return np.unique(gram_hashes(word_hashes(words), size))


def signature(grams: np.ndarray) -> np.ndarray:
    """The bands of a set, a number each: minima of ``ROWS * BANDS`` hash functions."""
    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), 2048):
        hashes = np.multiply.outer(_FACTORS, grams[i : i + 2048])
        hashes += _SHIFTS[:, None]
        np.minimum(low, hashes.min(axis=1), out=low)
    lanes = ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).reshape(BANDS, ROWS) & _LANES
    return np.bitwise_or.reduce(lanes << np.array([0, 16, 32, 48], np.uint64), axis=1).astype(np.int64)


def odd_cells(grams: np.ndarray) -> np.ndarray:
    """Which cells hold an odd number of shingles; sets differ in as many shingles at least."""
    odd = np.bincount((grams & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_unequal(compared: int, percent: int, miss: float) -> int:
    """How many of ``compared`` minima may differ before a pair is pruned.

    With all similarities alike probable before, that of a pair with ``m`` equal minima out of ``k``
    has a Beta distribution, and reaches the threshold with the probability that a binomial
    variable of ``k + 1`` trials is at most ``m``.
    """
    t = percent / 100
    reached, k = 0.0, compared + 1
    for equal in range(compared + 1):
        reached += comb(k, equal) * t**equal * (1 - t) ** (k - equal)
        if reached >= miss:
            return compared - equal
    return 0


def _profile(size: int):
    def profile(batches):
        for b in batches:
            rows = []
            for t in b["text"]:
                grams = shingles(t, size)
                key = xxhash.xxh3_128_hexdigest(grams.tobytes())
                rows.append((len(grams), key, signature(grams), odd_cells(grams)))
            n, key, bands, odd = zip(*rows, strict=True) if rows else ((), (), (), ())
            out = {"doc_id": b["doc_id"].astype("Int64"), "mark": b["mark"], "n": n, "set_key": key}
            yield pd.DataFrame(out | {"bands": bands, "odd": odd}).astype(
                {"n": "int64", "set_key": object, "bands": object, "odd": object}
            )

    return profile


def _sets(size: int):
    def sets(batches):
        for b in batches:
            rows = []
            for t, key, node in zip(b["text"], b["set_key"], b["node"], strict=True):
                grams = shingles(t, size)
                if xxhash.xxh3_128_hexdigest(grams.tobytes()) == key:
                    rows.append((node, grams.astype(np.int64)))
            yield pd.DataFrame(rows, columns=["node", "grams"]).astype({"node": "int64"})

    return sets


_BAND = [f"s{i}" for i in range(BANDS)]
_ODD = [f"p{i}" for i in range(SKETCH)]


def _possible(percent: int, miss: float) -> Column:
    """Neither sizes nor odd cells rule a pair out, nor does the posterior after any batch."""
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    bits = sum(F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in _ODD)
    kept = (small * 100 >= large * percent) & (
        bits * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)
    )
    for batch in range(BATCH, BANDS + 1, BATCH):
        differ = sum(
            F.bit_count((F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}")) + F.lit(_CARRY)).bitwiseAND(F.lit(_FLAGS)))
            for s in _BAND[:batch]
        )
        kept = kept & (differ <= most_unequal(batch * ROWS, percent, miss))
    return kept


def _side(classes: DataFrame, side: str, *more: str) -> DataFrame:
    return classes.select(*[F.col(c).alias(f"{side}_{c}") for c in ("node", "n", *_ODD, *_BAND, *more)])


def _first_shared() -> Column:
    """Whether a pair of one bucket agrees in no band before."""
    earlier = F.lit(False)
    for i, s in enumerate(_BAND[:-1]):
        earlier = earlier | ((F.col("a_band") > i) & (F.col(f"a_{s}") == F.col(f"b_{s}")))
    return ~earlier


def _confirmed(pairs: DataFrame, classes: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among ``pairs`` (a, b) by their whole sets; only texts of a pair are read again."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = classes.join(nodes, "node").select("node", "set_key", "doc_id", "no_id")
    keyed = rows.select("text", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("row_no_id"))
    found = rows_of(keyed, named).filter("no_id = row_no_id").select("text", "set_key", "node")
    sets = saved(in_slices(found, _sets(size), "node long, grams array<bigint>"), "minhash-sets")
    sets = sets.dropDuplicates(["node"])
    both = pairs.join(sets.toDF("a", "a_grams"), "a").join(sets.toDF("b", "b_grams"), "b")
    common = F.size(F.array_intersect("a_grams", "b_grams"))
    linked = common * (100 + percent) >= (F.size("a_grams") + F.size("b_grams")) * percent
    return saved(both.filter(linked).select("a", "b"), "minhash-links")


def minhash_components(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    miss: float = MISS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept, text_mark``.

    Words are runs without ASCII white space, with A-Z in lower case; a document's set are its
    distinct runs of ``size`` words, or all its words if they are fewer. Documents link when
    their intersection is at least ``percent`` percent of their union. ``component_id`` is the
    smallest id reachable by links; ``kept`` marks rows whose id that is. A null or empty text has
    no set and no link and is its own component. A null id is larger than any other; a component
    of null ids alone has a null id and its rows are kept. Rows with the same id are rows of their
    own. An empty table gives no rows.

    1. Equal sets become one class. Its signature are minima of hash functions over the set.
    2. Classes that agree in a band of the signature are in one bucket. A few members of
       a bucket, drawn by a hash, are tried with all others; links found join large families.
    3. In buckets where several components are left, members of different ones are compared,
       once for the first band that they share. Never are the pairs of a linked family formed.
    4. Both times a pair is compared by batches of its signature, and dropped as soon as the
       posterior probability of reaching the threshold is below ``miss``; the sizes and the odd
       cells of both sets drop what they prove to be below it. What is left is decided on whole sets.

    A link is missed with a probability of about ``miss`` by each batch, and in all bands as said
    at ``ROWS``; for thresholds far below 0.8 more bands are needed.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0 and at most 100")
    rows = texts(docs, id_col, text_col)
    profiles = saved(
        in_slices(
            rows.withColumn("mark", text_mark(F.col("text"))),
            _profile(size),
            "doc_id long, mark long, n long, set_key string, bands array<bigint>, odd array<bigint>",
        ),
        "minhash-profiles",
    )
    grouped = profiles.filter("n > 0").groupBy("set_key")
    classes = saved(
        grouped.agg(
            *[F.first(c).alias(c) for c in ("n", "bands", "odd")],
            F.min("doc_id").alias("smallest"),
            F.count(F.lit(1)).alias("copies"),
        ).select(
            F.monotonically_increasing_id().alias("node"),
            "set_key",
            "n",
            F.coalesce("smallest", F.lit(0)).alias("doc_id"),
            F.col("smallest").isNull().alias("no_id"),
            "copies",
            *[F.col("odd")[i].alias(p) for i, p in enumerate(_ODD)],
            *[F.col("bands")[i].alias(s) for i, s in enumerate(_BAND)],
        ),
        "minhash-classes",
    )
    in_band = classes.select("node", F.posexplode(F.array(*_BAND)).alias("band", "minima"))
    in_band = in_band.select("node", "band", F.xxhash64("band", "minima").alias("bucket"))
    drawn = F.xxhash64("node", "bucket")
    buckets = saved(
        in_band.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("rows"), F.min_by("node", drawn).alias("first"), F.max_by("node", drawn).alias("last"))
        .filter("rows > 1"),
        "minhash-buckets",
    )
    members = saved(looked_up(in_band, buckets, "bucket", "rows", BANDS * classes.count()), "minhash-members")
    tried = members.select("node", F.explode(F.array("first", "last")).alias("pivot")).filter("node <> pivot")
    tried = saved(
        tried.select(F.least("node", "pivot").alias("a_node"), F.greatest("node", "pivot").alias("b_node")).distinct(),
        "minhash-tried",
    )
    likely = tried.join(_side(classes, "a"), "a_node").join(_side(classes, "b"), "b_node").filter(_possible(percent, miss))
    first_pairs = saved(likely.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "minhash-first")
    first_links = _confirmed(first_pairs, classes, rows, size, percent)
    label = components(first_links).withColumnRenamed("id", "node")
    placed = saved(
        members.select("bucket", "band", "node", "rows")
        .join(label, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "minhash-placed",
    )
    mixed = saved(
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("rows").alias("weight"))
        .filter("low < high")
        .select("bucket", "weight"),
        "minhash-mixed",
    )
    left = looked_up(placed.drop("rows"), mixed, "bucket", "weight", placed.count()).drop("weight")
    left = saved(left.join(classes.select("node", "n", *_ODD, *_BAND), "node"), "minhash-left")
    a, b = _side(left, "a", "bucket", "band", "component"), _side(left, "b", "bucket", "component")
    pairs = a.join(b, F.col("a_bucket") == F.col("b_bucket")).filter(
        (F.col("a_node") < F.col("b_node"))
        & (F.col("a_component") != F.col("b_component"))
        & _possible(percent, miss)
        & _first_shared()
    )
    # The same pair can come twice only where hashes of two bands collide.
    pairs = saved(pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "minhash-pairs").distinct()
    links = first_links.unionByName(_confirmed(pairs, classes, rows, size, percent))
    labels = saved(components(links), "minhash-labels").withColumnRenamed("id", "node")
    joined = classes.select("node", "set_key", "doc_id", "no_id", "copies").join(labels, "node", "left")
    joined = joined.withColumn("component", F.coalesce("component", "node"))
    smallest = joined.groupBy("component").agg(F.min(F.when(~F.col("no_id"), F.col("doc_id"))).alias("component_id"))
    of_set = saved(joined.join(smallest, "component").select("set_key", "component_id", "copies"), "minhash-found")
    facts = profiles.select("doc_id", "mark", "n", "set_key")
    linked = looked_up(facts.filter("n > 0"), of_set, "set_key", "copies", facts.count()).drop("copies")
    alone = facts.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.col("mark").alias("text_mark"),
    )
