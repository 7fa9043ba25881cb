"""What the filters of fingerprints hold, and what of them comes to the driver."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import common, phrases


def plain_filter(prints, bits):
    array = np.zeros(bits // 64, np.uint64)
    for x in prints:
        at = int(np.int64(x).view(np.uint64)) % bits
        array[at // 64] |= np.uint64(1) << np.uint64(at % 64)
    return array


@pytest.mark.parametrize("n", [0, 1, 20_000])
def test_a_filter_has_the_bits_of_its_prints(spark, n):
    prints = spark.range(n, numPartitions=5).select(F.xxhash64("id").alias("print"))
    some = prints.unionByName(spark.createDataFrame([(0,), (-1,), (-1,), (2**63 - 1,), (-(2**63),)], "print long"))
    values = np.array([r[0] for r in some.collect()], np.int64)
    bits = common.filter_of(spark, some).value
    assert (bits == plain_filter(values, 1 << 16 if n < 4000 else 1 << 19)).all()
    assert common.passes(bits, values.view(np.uint64)).all()


def test_no_prints_make_an_empty_filter(spark):
    bits = common.filter_of(spark, spark.createDataFrame([], "print long")).value
    assert len(bits) == 1 << 10 and not bits.any()


def test_the_driver_gets_a_filter_as_bytes(spark):
    """Words of 64 bits as rows of Python objects would take some hundred bytes each."""
    prints = spark.range(1_000_000).select(F.xxhash64("id").alias("print"))
    tracemalloc.start()
    try:
        bits = common.filter_of(spark, prints).value
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert bits.nbytes == 1 << 21
    assert peak < 8 * bits.nbytes


@pytest.mark.parametrize("longest, filters", [(1, 0), (2, 0), (3, 1), (4, 2)])
def test_phrases_make_a_filter_for_longer_runs_only(spark, monkeypatch, longest, filters):
    made = []
    monkeypatch.setattr(phrases, "filter_of", lambda *a: made.append(common.filter_of(*a)) or made[-1])
    docs = spark.createDataFrame([(1, "x", "a b c d . a b c d")], "doc_id long, lang string, text string")
    counts = phrases.count_phrases(docs, longest=longest, least=2)
    assert len(made) == filters
    assert counts.filter("size > 0").count() == sum(range(4, 4 - longest, -1))
