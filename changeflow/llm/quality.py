"""Quality by importance resampling: how much likelier a text is under the target than under all."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import in_slices, quoted, rows_of, saved, texts, words_of

#: Buckets that words and pairs of words are hashed into.
BUCKETS = 10_007
SMOOTHING = 1.0


def bucket_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: words and pairs of neighbouring words, A-Z in lower case kept
    apart from capitals, since shouting is a sign too."""
    hashes = np.fromiter(map(zlib.crc32, words_of(text)), np.int64)
    pairs = (hashes[:-1] * 1_000_003 + hashes[1:] * 7 + 1) % buckets
    return np.bincount(np.concatenate([hashes % buckets, pairs]), minlength=buckets)


def bucket_model(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Smoothed log-probability of each bucket over all rows of ``docs``."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for t in b["text"]:
                total += bucket_counts(t, buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    found = (
        in_slices(docs.select("text"), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    n = np.full(buckets, SMOOTHING)
    for r in found:
        n[r["bucket"]] += r["n"]
    return np.log(n / n.sum())


def uniform(seed: int, *key: Column) -> Column:
    """A number between 0 and 1 that only the key and the seed decide."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024) -> float | None:
    """The k-th largest value, exactly, by counting in ever smaller ranges; null for k beyond."""
    value = F.col(column)
    low, high, n = df.agg(F.min(value), F.max(value), F.count(value)).first()
    if not 0 < k <= n:
        return None
    df = df.filter(value.isNotNull())
    while low < high:
        step = (high - low) / bins
        if step == 0 or low + step == low:
            break
        bin_of = F.least(F.floor((value - low) / step), F.lit(bins - 1))
        counts = (
            df.filter((value >= low) & (value <= high))
            .groupBy(bin_of.alias("bin"))
            .agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for r in counts:  # at most ``bins`` rows
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return high


def resample_quality(
    docs: DataFrame,
    labels: DataFrame,
    share: float = 0.8,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per input row: ``doc_id, log_weight, gumbel_key, selected``.

    The target model counts every text labelled 1, the raw model every text. The weight of a
    text is the ratio of its likelihoods; adding Gumbel noise and taking the largest keys draws
    without replacement in proportion to the weights. ``share`` of the rows, rounded up, is
    selected; rows that tie with the last one are selected too. The noise depends on the id, the
    seed and the text only, so a run can be repeated.

    A null or empty text has weight 0 in logarithms. Labels other than 1 and labels of null ids
    are not used; without labelled rows every weight is 0 and the draw is uniform. An empty
    table gives no rows. Models have ``buckets`` numbers each, whatever the corpus.
    """
    rows = texts(docs, id_col, text_col)
    good = (
        labels.select(quoted(id_col).cast("long").alias("doc_id"), quoted(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label = 1")
        .select("doc_id")
        .distinct()
    )
    target = rows_of(rows, good)
    raw_model, target_model = bucket_model(rows, buckets), bucket_model(target, buckets)
    uniform_model = np.allclose(target_model, target_model[0])
    ratio = np.zeros(buckets) if uniform_model else target_model - raw_model

    def weigh(batches):
        for b in batches:
            weight = [float(bucket_counts(t, buckets) @ ratio) for t in b["text"]]
            mark = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "log_weight": weight, "mark": mark}).astype(
                {"log_weight": float, "mark": "int64"}
            )

    weighed = in_slices(rows, weigh, "doc_id long, log_weight double, mark long")
    noise = -F.log(-F.log(uniform(seed, F.col("doc_id"), F.col("mark"))))
    keyed = saved(weighed.withColumn("gumbel_key", F.col("log_weight") + noise).drop("mark"), "quality")
    n = keyed.count()
    last = kth_largest(keyed, "gumbel_key", int(np.ceil(share * n))) if n else None
    chosen = F.lit(False) if last is None else F.col("gumbel_key") >= F.lit(float(last))
    return keyed.withColumn("selected", chosen)
