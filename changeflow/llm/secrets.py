"""Secret scans: base patterns with their places, and weak parts that complement each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import saved, texts


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + "|" + (
    "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
_VALUE = "[A-Za-z0-9+/_.=-]"

#: kind -> pattern, the least length of a match's value, and what precedes the value in a match.
#: A run of hex digits of which 24 are asked for is the same as such a run of 24 and more; the
#: same holds for the letters and digits after AKIA.
HEAD = rf"(?:{_NAMES})[\"']?\x20*[:=]\x20*[\"']?"
BASE = {
    "assign": rf"{HEAD}{_VALUE}+",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
LEAST_VALUE = 6
#: Parts that mean little alone. Identifiers include the base kind ``access``.
IDENTIFIERS = r"\b(?:ASIA[A-Z0-9]{12,}|(?:[Uu]ser(?:name)?|[Ll]ogin|[Aa]ccess_?[Kk]ey_?[Ii]d)\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@+-]{3,})"
#: A whole run of 32 characters or more with a digit and a capital letter. The value of a name
#: may stand directly after "="; a run that "=" and a value follow is a name itself.
SECRETS = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])[A-Za-z0-9+/_-]{32,}+={0,2}+(?![A-Za-z0-9+/=_-])"
ENDPOINTS = r"\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9.-]+(?::[0-9]{2,5})?"
KINDS = (*BASE, "secret", "endpoint")
#: Steps of the running sums; places of n matches cost about n times this.
STEP = 64


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, even if a function inside uses it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """Running sums of an array, in blocks so that long arrays don't cost their square."""
    add = lambda a, x: a + x
    zero = F.lit(0).cast("long")
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP).cast("int"))

    def over(sums):
        def block(b):
            before = F.aggregate(F.slice(sums, 1, b), zero, add)
            return _let(
                F.slice(lengths, b * STEP + 1, STEP),
                lambda own: _let(
                    before,
                    lambda start: F.transform(
                        own, lambda _, i: start + F.aggregate(F.slice(own, 1, i + 1), zero, add)
                    ),
                ),
            )

        return F.flatten(F.transform(blocks, block))

    return _let(
        F.transform(blocks, lambda b: F.aggregate(F.slice(lengths, b * STEP + 1, STEP), zero, add)), over
    )


def _spans(text: Column, pattern: str, least: int = 0) -> Column:
    """Places of the leftmost matches that don't overlap, in code points, end exclusive.

    What lies between matches and the matches themselves alternate, so running sums of both
    lengths are the places. With ``least``, matches with a shorter value are dropped afterwards.
    """
    long = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("long")
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("m"))

    def places(z):
        steps = F.flatten(F.transform(z, lambda p: F.array(long(p["gap"]), long(p["m"]))))

        def cut(ends):
            return F.transform(
                z,
                lambda p, i: F.struct(
                    F.get(ends, 2 * i).alias("start"), F.get(ends, 2 * i + 1).alias("end"), p["m"].alias("m")
                ),
            )

        return _let(steps, lambda lengths: _let(_running(lengths), cut))

    right = lambda s: s["m"].isNotNull()
    if least:
        right = lambda s: F.length(F.regexp_replace(s["m"], f"^{HEAD}", "")) >= least
    spans = F.transform(
        F.filter(_let(pieces, places), right),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
    )
    return F.when(text.rlike(pattern), spans).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint>>")
    )


def _named(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end")
        ),
    )


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined with commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 256
) -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, n_linked, base, spans``.

    ``base`` and ``spans`` are ``kind:start:end`` by start and kind, joined with commas; ``base``
    has the kinds of ``BASE`` only. A long mixed token counts as ``secret`` and an address as
    ``endpoint`` only where the other parts stand at most ``scope`` characters away: a secret
    needs an identifier, an endpoint needs an identifier and a secret. Alone they are ordinary
    text and not reported. Tokens that overlap a base match are not repeated.

    The linking is an interval join. Places are dealt into cells as wide as the scope, each cell is
    reduced to its first and last place of a kind before the join, and a candidate looks into three
    cells, so a text with many parts makes no pairs of them.

    A null text is empty and has no spans; ids may be null or repeat, every row is scanned by
    itself. An empty table gives no rows.
    """
    spark = docs.sparkSession
    t = F.col("text")
    kept_base = {k: _spans(t, p, LEAST_VALUE if k == "assign" else 0) for k, p in BASE.items()}
    found = saved(
        texts(docs, id_col, text_col).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            *[v.alias(k) for k, v in kept_base.items()],
            _spans(t, IDENTIFIERS).alias("identifiers"),
            _spans(t, SECRETS).alias("secrets"),
            _spans(t, ENDPOINTS).alias("endpoints"),
        ),
        "secret-parts",
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    parts = found.filter(F.size("secrets") + F.size("endpoints") > 0).select(
        "row",
        F.explode(
            F.concat(
                F.transform("identifiers", lambda s: F.struct(F.lit("i").alias("part"), s["start"].alias("start"), s["end"].alias("end"), F.lit(False).alias("covered"))),
                F.transform("access", lambda s: F.struct(F.lit("i").alias("part"), s["start"].alias("start"), s["end"].alias("end"), F.lit(True).alias("covered"))),
                F.transform(
                    "secrets",
                    lambda s: F.struct(
                        F.lit("s").alias("part"),
                        s["start"].alias("start"),
                        s["end"].alias("end"),
                        F.exists(
                            F.concat("assign", "access", "hex"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
                        ).alias("covered"),
                    ),
                ),
                F.transform("endpoints", lambda s: F.struct(F.lit("e").alias("part"), s["start"].alias("start"), s["end"].alias("end"), F.lit(False).alias("covered"))),
            )
        ).alias("p"),
    ).select("row", "p.*", F.floor(F.col("p.start") / scope).alias("cell"))
    edges = parts.filter("part in ('i', 's')").groupBy("row", "cell").agg(
        *[
            f(F.when(F.col("part") == p, F.col("start"))).alias(f"{p}_{name}")
            for p in "is"
            for f, name in ((F.min, "first"), (F.max, "last"))
        ]
    )
    wanted = parts.filter("part in ('s', 'e')").select(
        "row", "part", "start", "end", "covered", F.explode(F.array(*[F.col("cell") + d for d in (-1, 0, 1)])).alias("cell")
    )
    near = lambda p: reduce(
        lambda a, b: a | b,
        [
            F.coalesce(F.abs(F.col(f"{p}_{name}") - F.col("start")) <= scope, F.lit(False))
            for name in ("first", "last")
        ],
    )
    linked = (
        wanted.join(edges, ["row", "cell"])
        .groupBy("row", "part", "start", "end", "covered")
        .agg(F.max(near("i")).alias("i"), F.max(near("s")).alias("s"))
        .filter("i and s and not covered")
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct(
                    "start",
                    F.when(F.col("part") == "s", F.lit(KINDS.index("secret"))).otherwise(F.lit(KINDS.index("endpoint"))).alias("rank"),
                    "end",
                )
            ).alias("linked")
        )
    )
    base = F.concat(*[_named(k, F.col(k)) for k in BASE])
    return (
        found.join(linked, "row", "left")
        .withColumn("linked", F.coalesce("linked", none))
        .select(
            "doc_id",
            *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
            F.size("linked").cast("long").alias("n_linked"),
            _joined(base).alias("base"),
            _joined(F.concat(base, "linked")).alias("spans"),
        )
    )
