"""N-gram Jaccard join: a sparse product of documents by n-grams, in blocks of columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import (
    components,
    in_slices,
    mixed,
    one_of_twins,
    quoted,
    rows_of,
    saved,
    text_mark,
    texts,
    without,
    word_hashes,
    words_of,
)

#: Overlap that a pair must have in the first block, in percent of a document's n-grams, minus 1.
EVIDENCE = 5
#: Columns with more documents than this may be left out of a block, the longest ones first.
COMMON = 1
#: Rows of a column that all its others try first, to join large groups before their pairs are formed.
TRIED = 4
#: A product is passed over if the pair meets in one of so many columns before it as well.
BEFORE = 3
#: Words of the sketch that stands in every column, and the most words of a document's own sketch.
SKETCH, WIDEST = 4, 4096


def ngrams(words: list[bytes], size: int) -> np.ndarray:
    """The distinct n-grams as sorted 64-bit numbers; fewer words than ``size`` are one n-gram.

    The high byte falls with the n-gram's length in bytes and the rest is a hash, so the order puts
    long n-grams first. They are rare, while short ones of common words fill long columns.
    """
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        whole = b"\x20".join(words)
        hashes, lengths = np.array([xxhash.xxh3_64_intdigest(whole, seed=1)], np.uint64), np.array([len(whole)])
    else:
        hash_, length = word_hashes(words), np.fromiter(map(len, words), np.int64, len(words))
        n = len(words) - size + 1
        hashes, lengths = hash_[:n].copy(), length[:n].copy()
        for i in range(1, size):
            hashes *= np.uint64(0x9E3779B97F4A7C15)
            hashes += hash_[i : i + n]
            lengths += length[i : i + n]
        hashes = mixed(hashes)
    rank = (127 - np.minimum(lengths // 2, 127)).astype(np.uint64)
    return np.unique((rank << np.uint64(56)) | (hashes >> np.uint64(8)))


def first_block(n: int, percent: int) -> int:
    """How many n-grams of a set of ``n`` stand in the first block.

    Two sets that reach the similarity share at least ``percent`` of each set. All but
    ``need - evidence`` of a set being in the block, the pair shares ``evidence`` n-grams in it.
    """
    need = -(-n * percent // 100)
    return min(n, n - need + evidence(n))


def evidence(n):
    return 1 + n * EVIDENCE // 100


def _spare(n: Column, percent: int) -> Column:
    """How many columns of a block may be left out, if they are its last in an order that all share.

    A pair then misses the larger of two such numbers at most; ``_least_shared`` stays above 0.
    """
    return F.greatest(F.lit(0), F.floor(n * min(EVIDENCE, percent // 2) / 100) - 1)


def _least_shared(percent: int) -> Column:
    """How many columns sets of ``a_n`` and ``b_n`` share at least, of those not left out.

    The overlap is ``percent`` percent of the union or more. What is missing from one of the blocks
    stands in the tail of one set, as both are the first part in the same order.
    """

    def tail(n: Column) -> Column:
        return F.greatest(F.lit(0), F.ceil(n * percent / 100) - 1 - F.floor(n * EVIDENCE / 100))

    a, b = F.col("a_n"), F.col("b_n")
    left_out = F.greatest(_spare(a, percent), _spare(b, percent))
    return F.ceil((a + b) * percent / (100 + percent)) - F.greatest(tail(a), tail(b)) - left_out


def parity(grams: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """For each of 64 cells a word, whether it has an odd number of n-grams.

    Two sets differ by at least as many n-grams as their words have different bits. ``words``
    is a power of two; the exclusive or of both halves is the sketch of half as many words.
    """
    odd = np.bincount((grams & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def own_parity(grams: np.ndarray) -> np.ndarray:
    """``parity`` with two cells or more for each n-gram, up to ``WIDEST`` words."""
    words = SKETCH
    while words < WIDEST and 64 * words < 2 * len(grams):
        words *= 2
    return parity(grams, words)


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """In how many n-grams at least two sets differ, by their own sketches."""
    words = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, words), axis=0) for x in (a, b))
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum())


def _profile(size: int, percent: int):
    def profile(batches):
        for b in batches:
            rows = []
            for t in b["text"]:
                grams = ngrams(words_of(t, fold=True), size)
                block = grams[: first_block(len(grams), percent)].astype(np.int64)
                key = xxhash.xxh3_128_hexdigest(grams.tobytes())
                rows.append((len(grams), key, block, parity(grams), own_parity(grams).tobytes()))
            n, key, block, sketch, own = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"),
                    "mark": b["mark"],
                    "n": n,
                    "set_key": key,
                    "block": block,
                    "sketch": sketch,
                    "own": own,
                }
            ).astype({"n": "int64", "set_key": object, "block": object, "sketch": object, "own": object})

    return profile


def _sets(size: int):
    def sets(batches):
        for b in batches:
            rows = []
            for t, key, node in zip(b["text"], b["set_key"], b["node"], strict=True):
                grams = ngrams(words_of(t, fold=True), size)
                if xxhash.xxh3_128_hexdigest(grams.tobytes()) == key:
                    rows.append((node, grams.astype(np.int64)))
            yield pd.DataFrame(rows, columns=["node", "grams"]).astype({"node": "int64"})

    return sets


def _sizes_fit(percent: int) -> Column:
    return F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent


def _possible(percent: int) -> Column:
    """What sizes and sketches allow: neither the smaller set nor the differing bits rule it out."""
    bits = sum(F.bit_count(F.col(f"a_s{i}").bitwiseXOR(F.col(f"b_s{i}"))) for i in range(SKETCH))
    return _sizes_fit(percent) & (
        bits * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)
    )


def _met_before() -> Column:
    """Whether a pair also shares one of the columns before, where it came up or was passed over.

    The first column that a pair shares has none before it, so the pair comes up there.
    """
    places = range(1, BEFORE + 1)
    met = F.lit(False)
    for i in places:
        for k in places:
            met = met | F.coalesce(F.col(f"a_before{i}") == F.col(f"b_before{k}"), F.lit(False))
    return met


def _side(columns: DataFrame, side: str) -> DataFrame:
    return columns.select("gram", *[F.col(c).alias(f"{side}_{c}") for c in columns.columns if c != "gram"])


def _near(percent: int):
    def near(batches):
        for b in batches:
            kept = []
            for a_n, b_n, a_own, b_own in zip(b["a_n"], b["b_n"], b["a_own"], b["b_own"], strict=True):
                bits = differing(np.frombuffer(a_own, np.int64), np.frombuffer(b_own, np.int64))
                kept.append(bits * (100 + percent) <= (int(a_n) + int(b_n)) * (100 - percent))
            yield b.loc[np.array(kept, bool), ["a", "b"]].astype("int64")

    return near


def _not_ruled_out(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those with ``a_n`` and ``b_n`` that the documents' own sketches allow."""
    for side in "ab":
        pairs = pairs.join(
            classes.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("own").alias(f"{side}_own")),
            side,
        )
    found = in_slices(pairs.select("a", "b", "a_n", "b_n", "a_own", "b_own"), _near(percent), "a long, b long")
    return saved(found, "ngram-likely")


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among ``pairs`` (a, b), by the overlap of the whole sets.

    Only the texts of documents in a pair are read again and their sets formed.
    """
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    named = classes.join(nodes, "node", "left_semi").select("node", "set_key", "doc_id", "no_id")
    keyed = rows.withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    found = rows_of(keyed.withColumnRenamed("no_id", "row_no_id"), named).filter("no_id = row_no_id")
    sets = saved(
        in_slices(found.select("text", "set_key", "node"), _sets(size), "node long, grams array<bigint>"), "sets"
    ).dropDuplicates(["node"])
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("a_grams"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("b_grams"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.size(F.array_intersect("a_grams", "b_grams"))
    linked = overlap * (100 + percent) >= (F.size("a_grams") + F.size("b_grams")) * percent
    return saved(both.filter(linked).select("a", "b"), "links")


def ngram_components(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, text_mark, component``.

    Words are runs without ASCII white space, with A-Z in lower case; a document's set are its
    distinct runs of ``size`` words, or all its words if they are fewer. Two documents link when
    their intersection is at least ``percent`` percent of their union; ``component_id`` is the
    smallest id reachable by links. A null or empty text has no n-grams and no link. A null id is larger
    than any other; a component of null ids alone has the id null and ``component`` still names
    it. Rows with the same id are rows of their own. An empty table gives no rows.

    Documents are the rows and n-grams the columns of a sparse matrix whose product with its
    transpose holds the overlaps.

    1. Equal sets become one row (a class), so copies are not multiplied with each other.
    2. The first block of columns of a row are its first n-grams in a fixed order, as many as a
       pair above the threshold must share ``evidence`` of. Columns with one row are left out.
       The last of a block in the order of the columns' lengths are left out too: as many
       as ``_spare`` says, which leaves every pair above the threshold a column. Most long columns go that way.
    3. The block is multiplied by a join on the n-gram. Sizes and a short parity sketch discard
       pairs in the join. A product is also passed over if the pair meets in one of the ``BEFORE``
       columns that stand before it in both blocks; its first column always counts, so a pair comes
       up a few times however much it shares.
    4. Sketches of the documents' own size discard pairs that are told to be below the threshold.
    5. For what is left the whole sets are intersected.

    Before step 3 each row of a column tries ``TRIED`` that hashes put first there. In a group of
    near copies those are the same ones in most columns, so those links join large groups, columns
    of one group alone are done with, and step 3 forms pairs between groups only.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0 and at most 100")
    rows = texts(docs, id_col, text_col)
    profiles = saved(
        in_slices(
            rows.withColumn("mark", text_mark(F.col("text"))),
            _profile(size, percent),
            "doc_id long, mark long, n long, set_key string, block array<bigint>, sketch array<bigint>, own binary",
        ),
        "ngram-profiles",
    )
    classes = saved(
        profiles.filter("n > 0")
        .groupBy("set_key")
        .agg(
            F.first("n").alias("n"),
            F.first("block").alias("block"),
            F.first("sketch").alias("sketch"),
            F.first("own").alias("own"),
            F.min("doc_id").alias("smallest"),
        )
        .select(
            F.monotonically_increasing_id().alias("node"),
            "set_key",
            "n",
            F.coalesce("smallest", F.lit(0)).alias("doc_id"),
            F.col("smallest").isNull().alias("no_id"),
            "block",
            "own",
            *[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH)],
        ),
        "ngram-classes",
    )
    incidence = classes.select("node", F.explode("block").alias("gram"))
    column = Window.partitionBy("gram")
    shared = saved(
        incidence.withColumn("rows", F.count(F.lit(1)).over(column)).filter("rows > 1"), "ngram-columns"
    )
    longest = Window.partitionBy("node").orderBy(F.desc("rows"), "gram")
    placed = shared.join(classes.select("node", "n"), "node").withColumn("place", F.row_number().over(longest))
    block = saved(
        placed.filter((F.col("place") > _spare(F.col("n"), percent)) | (F.col("rows") <= COMMON)).select("gram", "node", "n"),
        "ngram-block",
    )
    # First links: with some rows of each column, mostly the same ones throughout a group.
    drawn = [
        F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("draw"), F.col("node").alias("other"), F.col("n").alias("b_n")))
        .over(column)
        .dropFields("draw")
        for k in range(TRIED)
    ]
    tried = block.select("node", F.col("n").alias("a_n"), F.array(*drawn).alias("drawn"))
    tried = tried.select("node", "a_n", F.inline(F.array_distinct("drawn")))
    tried = tried.filter((F.col("node") != F.col("other")) & _sizes_fit(percent)).groupBy(
        "node", "other", "a_n", "b_n"
    )
    tried = tried.agg(F.count(F.lit(1)).alias("overlap")).filter(F.col("overlap") * 2 >= _least_shared(percent))
    tried = tried.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    likely = _not_ruled_out(tried, classes, percent)
    first_links = _verified(likely, classes, rows, size, percent)
    first_labels = saved(components(first_links), "ngram-labels")
    labelled = block.join(first_labels.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    ends = (F.min("component").over(column).alias("low"), F.max("component").over(column).alias("high"))
    several = saved(
        labelled.select("gram", "node", "component", *ends).filter("low < high").drop("low", "high"),
        "ngram-labelled",
    )
    in_order = Window.partitionBy("node").orderBy("gram")
    facts = classes.select("node", "n", *[f"s{i}" for i in range(SKETCH)])
    several = saved(
        several.join(facts, "node").select(
            "*", *[F.lag("gram", k).over(in_order).alias(f"before{k}") for k in range(1, BEFORE + 1)]
        ),
        "ngram-met",
    )
    a, b = _side(several, "a"), _side(several, "b")
    products = a.join(b, "gram").filter(
        (F.col("a_node") < F.col("b_node"))
        & (F.col("a_component") != F.col("b_component"))
        & _possible(percent)
        & ~_met_before()
    )
    met = saved(products.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "ngram-candidates")
    candidates = _not_ruled_out(met.distinct(), classes, percent)
    links = first_links.unionByName(_verified(candidates, classes, rows, size, percent))
    labels = saved(components(links), "ngram-labels")
    members = classes.select("node", "set_key", "doc_id", "no_id").join(
        labels.withColumnRenamed("id", "node"), "node", "left"
    )
    members = members.withColumn("component", F.coalesce("component", "node"))
    smallest = members.groupBy("component").agg(
        F.min(F.when(~F.col("no_id"), F.col("doc_id"))).alias("component_id")
    )
    of_set = members.select("set_key", "component").join(smallest, "component")
    return profiles.select("doc_id", "mark", "n", "set_key").join(of_set, "set_key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("mark").alias("text_mark"),
        "component",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each linked group does, all columns.

    The smallest id of a group stays, of rows with that id the one with the smallest text mark,
    and one of the rows equal in both. Documents without n-grams all stay.
    """
    found = saved(ngram_components(docs, id_col=id_col, text_col=text_col, **options), "ngram-components")
    grouped = found.filter("n_shingles > 0").withColumn("no_id", F.col("doc_id").isNull())
    place = F.struct("no_id", "doc_id", "text_mark")
    stays = grouped.groupBy("component").agg(F.min(place).alias("stay"), F.count(F.lit(1)).alias("rows"))
    judged = grouped.join(stays.filter("rows > 1"), "component").withColumn("stays", place.eqNullSafe(F.col("stay")))
    marked = judged.select("doc_id", F.col("text_mark").alias("key"), "stays")
    key = text_mark(quoted(text_col))
    twins = marked.filter("stays").groupBy("doc_id", "key").count().filter("count > 1").select("doc_id", "key")
    rest = without(docs, marked.filter("not stays").select("doc_id", "key"), key, id_col)
    return one_of_twins(rest, twins, key, id_col)
