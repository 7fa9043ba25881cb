"""Merkle manifest of a table: a tree per group of rows, a tree over the groups, proofs for rows.

Only every ``STEP``-th level of a tree is stored; what lies between is computed again from the
stored level below when proofs are taken, and forgotten. All steps are DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import partitions, quoted, saved

#: Levels from one stored level to the next; an aligned subtree between two has 2**STEP nodes at most.
STEP = 6


class Forest(NamedTuple):
    """The stored levels of the trees of all groups.

    ``levels[k]`` has one row per aligned subtree above level ``k * STEP``: ``grp, block, height``
    (levels up to the root) and ``members`` (id, digest, claimed) of its lowest level, in order.
    ``roots`` has ``grp, digest``.
    """

    levels: list[DataFrame]
    roots: DataFrame


class Manifest(NamedTuple):
    """``rows``: a tree per group; ``groups``: the tree over the roots of the groups."""

    rows: Forest
    groups: Forest


def field(value: Column) -> Column:
    """A value as leaves are hashed: ``-`` if null, else its length in bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def _parents(nodes: Column) -> Column:
    """Digests of the next level: of every two, and of the last one alone if it has no partner."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")),
        lambda i: F.sha2(F.concat(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))), 256),
    )


def _interior(digests: Column, levels: Column) -> Column:
    """All levels of an aligned subtree, the given one first."""
    return F.aggregate(
        F.sequence(F.lit(0), levels),
        F.array(digests),
        # The first step of the sequence only starts it, so that it is never empty.
        lambda done, i: F.when(i == 0, done).otherwise(
            F.concat(done, F.array(_parents(F.element_at(done, -1))))
        ),
    )


def _levels() -> Column:
    return F.least(F.col("height"), F.lit(STEP))


def _digests() -> Column:
    return F.transform("members", lambda m: m["digest"])


def _ranked(nodes: DataFrame) -> DataFrame:
    """``nodes`` (grp, id, digest, claimed) with ``place`` in its group and ``total`` of the group.

    Rows are range-partitioned by group, id and digest and numbered by task; a group larger than
    a partition spans several. Only counts by task and group are summed up in a window.
    """
    n = partitions(nodes.sparkSession)
    order = ["grp", "id", "digest", "claimed"]
    ordered = nodes.repartitionByRange(n, *order).sortWithinPartitions(*order)
    numbered = saved(ordered.withColumn("number", F.monotonically_increasing_id()), "merkle-order")
    task = F.shiftright("number", 33)
    runs = numbered.groupBy("grp", task.alias("task")).agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    of_group = Window.partitionBy("grp")
    before = F.sum("rows").over(of_group.orderBy("task")) - F.col("rows")
    runs = saved(
        runs.select("grp", "task", (before - F.col("first")).alias("shift"), F.sum("rows").over(of_group).alias("total")),
        "merkle-runs",
    )
    placed = numbered.withColumn("task", task).join(runs, ["grp", "task"])
    return placed.withColumn("place", F.col("number") + F.col("shift")).drop("number", "shift", "task")


def _height(total: Column) -> Column:
    """Levels from ``total`` nodes to one: the bits of ``total - 1``."""
    return F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0)


def build_forest(nodes: DataFrame) -> Forest:
    """The trees over ``nodes`` (grp, id, digest, claimed), ordered by id within a group."""
    ranked = _ranked(nodes).withColumn("height", _height(F.col("total")))
    levels, roots = [], None
    while True:
        block = F.floor(F.col("place") / (1 << STEP)).cast("long")
        member = F.struct("place", "id", "digest", "claimed")
        stored = saved(
            ranked.groupBy("grp", block.alias("block"))
            .agg(F.max("height").alias("height"), F.sort_array(F.collect_list(member)).alias("members"))
            .withColumn("members", F.transform("members", lambda m: m.dropFields("place"))),
            f"merkle-level-{STEP * len(levels)}",
        )
        levels.append(stored)
        top = F.element_at(_interior(_digests(), _levels()), -1)
        above = stored.select("grp", F.col("block").alias("place"), "height", top[0].alias("digest"))
        done = above.filter(F.col("height") <= STEP).select("grp", "digest")
        roots = done if roots is None else roots.unionByName(done)
        rest = above.filter(F.col("height") > STEP)
        # The height of the tallest tree is one number.
        if (stored.agg(F.max("height")).first()[0] or 0) <= STEP:
            return Forest(levels, saved(roots, "merkle-roots"))
        nothing = F.lit(None).cast("string").alias("claimed")
        ranked = rest.select(
            "grp", "place", F.lit(None).cast("string").alias("id"), "digest", nothing, (F.col("height") - STEP).alias("height")
        )


def build_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "lang",
    id_col: str = "doc_id",
    claims: dict[str, Column] | None = None,
) -> Manifest:
    """Hash every row of ``docs`` and store every ``STEP``-th level of the trees.

    A leaf is the digest of ``columns``, see ``field``; an empty text and a null are different
    leaves. Within a group leaves ascend by id, a null id comes first, rows with the same id are
    ordered by their digest, and equal rows are leaves of their own. A null group is a group
    and comes first; others follow in the order of their bytes. Every two consecutive nodes
    become one, a last one alone becomes the digest of itself, until one is left. A group of one
    row has its leaf as root. Other columns are not read. An empty table has no root.

    ``claims`` are other values for some columns, as someone else has them. Where they change
    the leaf, its digest is kept with the row, to be tried against the proof.
    """
    claims = claims or {}
    own = leaf([quoted(c) for c in columns])
    other = leaf([claims.get(c, quoted(c)) for c in columns]) if claims else F.lit(None).cast("string")
    # Where no value differs, the text is not hashed again.
    differs = F.lit(False)
    for name, value in claims.items():
        differs = differs | ~value.eqNullSafe(quoted(name))
    named = F.coalesce(F.concat(F.lit("="), quoted(group_col).cast("string")), F.lit(""))
    leaves = saved(
        docs.select(
            named.alias("grp"),
            quoted(id_col).cast("long").alias("id"),
            own.alias("digest"),
            F.when(differs, other).alias("claimed"),
        ),
        "merkle-leaves",
    )
    rows = build_forest(leaves)
    nothing = F.lit(None).cast("string").alias("claimed")
    subroots = rows.roots.select(F.lit("").alias("grp"), F.col("grp").alias("id"), "digest", nothing)
    return Manifest(rows, build_forest(subroots))


def _proofs(forest: Forest, tops: DataFrame) -> DataFrame:
    """Members of the lowest level with their proofs.

    ``tops`` has ``grp, path`` and what else is to be carried along for every group. Level by
    level from the top, a subtree's interior is computed from its stored nodes and its siblings
    are put before those above it.
    """
    carried = [c for c in tops.columns if c not in ("grp", "path")]
    above, found = None, None
    for k in reversed(range(len(forest.levels))):
        stored = forest.levels[k]
        # A tree ends at the level whose only subtree reaches the root.
        ends = stored.filter((F.col("height") <= STEP) & (F.col("block") == 0)).select("grp")
        known = tops.join(ends, "grp").select("grp", F.lit(0).cast("long").alias("block"), "path", *carried)
        if above is not None:
            known = known.unionByName(above)
        held = stored.join(known, ["grp", "block"])
        below = lambda j: F.lit(1 << j)

        def siblings(all_levels: Column, i: Column) -> Column:
            steps = []
            for j in range(STEP):
                place = F.floor(i / below(j)).cast("int")
                left = place % 2 == 1
                at = F.when(left, place - 1).otherwise(place + 1)
                step = F.struct(F.get(F.get(all_levels, F.lit(j)), at).alias("sibling"), left.alias("is_left"))
                steps.append(step)
            return F.slice(F.array(*steps), F.lit(1), F.size(all_levels) - 1)

        inner = _bound(
            _interior(_digests(), _levels()),
            lambda all_levels: F.transform("members", lambda m, i: F.struct(m.alias("m"), siblings(all_levels, i).alias("inner"))),
        )
        rows = held.select("grp", "block", "path", *carried, F.posexplode(inner).alias("at", "member"))
        full = F.concat(F.col("member.inner"), F.col("path")).alias("path")
        if k:
            place = (F.col("block") * (1 << STEP) + F.col("at")).alias("block")
            above = rows.select("grp", place, full, *carried)
        else:
            found = rows.select("grp", "member.m.*", full, *carried)
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """One row per row of the table: ``id, leaf, claimed, subroot, root, path``.

    ``path`` leads from the leaf over the root of its group to the root, one step a level:
    ``sibling`` (null where a node has no partner) and ``is_left`` (whether it stands before).
    """
    nothing = F.array().cast("array<struct<sibling: string, is_left: boolean>>")
    top = manifest.groups.roots.select("grp", nothing.alias("path"), F.col("digest").alias("root"))
    groups = _proofs(manifest.groups, top)
    tops = groups.select(F.col("id").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    return _proofs(manifest.rows, tops).select(
        "id", F.col("digest").alias("leaf"), "claimed", "subroot", "root", "path"
    )


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(
        path,
        start,
        lambda node, step: F.sha2(
            F.when(step["is_left"], F.concat(step["sibling"], node)).otherwise(
                F.concat(node, F.coalesce(step["sibling"], F.lit("")))
            ),
            256,
        ),
    )


def path_digest(path: Column) -> Column:
    """Digest of the siblings of a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda step: step["sibling"]), ""), 256)


def root_of(spark: SparkSession, manifest: Manifest) -> str | None:
    """The digest of the whole table; ``None`` for an empty one."""
    found = manifest.groups.roots.select("digest").first()
    return found[0] if found else None
