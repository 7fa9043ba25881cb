"""The Merkle manifest, collocations and MinHash components against plain Python, and odd input."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402

from changeflow.llm import merkle, minhash, phrases  # noqa: E402
from changeflow.llm.queries import QUERIES  # noqa: E402

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
# Names that the operators use themselves.
CLASH = "grp id digest claimed place block height members phrase n a b l r size node bands bucket mark"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.fixture(scope="module")
def documents(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=COLUMNS)
    return list(zip(*[table[c].to_pylist() for c in COLUMNS], strict=True))


@pytest.fixture(scope="module")
def odd_rows():
    rows = [
        (1, "web", "en", 5, "Same text, here. Same text"),
        (2, None, "en", None, "same TEXT here"),
        (2, None, "en", None, "same TEXT here"),
        (None, "web", None, 3, None),
        (None, "web", "en", 3, "abc"),
        (5, "é", "zz", 0, ""),
        (6, "web", "", 7, LONG),
        (7, "web", "é", 7, LONG + " end"),
        (8, "web", None, -4, " \t\n "),
        (9, "web", "en", 2**62, "a b\tc;d\x0be"),
    ]
    return rows + [(i, "many", "fr", i, f"le mot juste {i} . le mot juste") for i in range(100, 300)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    frame = spark.createDataFrame(odd_rows, "doc_id long, source string, lang string, n_chars long, text string")
    return frame.repartition(5).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH.split())])


def seventh(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def proved(docs, claims=None):
    rows = merkle.proofs(merkle.build_manifest(docs, claims=claims)).select(
        "id",
        "leaf",
        "subroot",
        "root",
        merkle.path_digest(F.col("path")),
        merkle.folded(F.coalesce("claimed", "leaf"), F.col("path")),
    )
    return [tuple(r) for r in rows.collect()]


def test_merkle_of_a_table(spark, sf_dir, documents):
    rows = QUERIES["op11_merkle"](spark, sf_dir).collect()
    assert sorted(tuple(r)[:6] for r in rows) == sorted(plain.merkle(documents, seventh))
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in rows)
    wrong = {r["doc_id"] for r in rows if not r["verified"]}
    assert wrong == {d[0] for d in documents if seventh(d[0]) and d[3] is not None}


def test_merkle_of_odd_rows(odd, odd_rows):
    tried = F.when(F.col("doc_id") % 2 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    want = plain.merkle(odd_rows, lambda i: i is not None and i % 2 == 0)
    assert sorted(map(str, proved(odd, {"n_chars": tried}))) == sorted(map(str, want))


@pytest.mark.parametrize("n", [1, 2, 3, 63, 64, 65, 129, 4097])
def test_merkle_heights(spark, n):
    docs = spark.range(n).selectExpr("id AS doc_id", "'s' AS source", "'x' AS lang", "id AS n_chars", "'t' AS text")
    want = plain.merkle([(i, "s", "x", i, "t") for i in range(n)], lambda i: False)
    assert sorted(proved(docs)) == sorted(want)


def test_merkle_many_groups_and_none(spark, odd):
    docs = spark.range(300).selectExpr(
        "id AS doc_id", "'s' AS source", "concat('g', id % 131) AS lang", "id AS n_chars", "'t' AS text"
    )
    want = plain.merkle([(i, "s", f"g{i % 131}", i, "t") for i in range(300)], lambda i: False)
    assert sorted(proved(docs)) == sorted(want)
    empty = merkle.build_manifest(odd.filter("false"))
    assert merkle.proofs(empty).count() == 0 and merkle.root_of(odd.sparkSession, empty) is None


def test_merkle_keeps_every_few_levels_only(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'s' AS source", "'x' AS lang", "id AS n_chars", "'t' AS text")
    manifest = merkle.build_manifest(docs)
    stored = [sum(len(r["members"]) for r in level.collect()) for level in manifest.rows.levels]
    assert stored == [5000, 79, 2]


def test_collocations_of_a_table(spark, sf_dir, documents):
    want = plain.collocations([(d[0], d[2], d[4]) for d in documents])
    got = [tuple(r) for r in QUERIES["op12_phrases"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want) and want


def test_collocations_of_odd_rows(odd, odd_rows):
    rows = [(r[0], r[2], r[4]) for r in odd_rows]
    for options in ({"longest": 4, "least": 2, "within": 80, "most": 25}, {"longest": 2, "least": 1}):
        got = [tuple(r)[:8] for r in phrases.collocations(odd, **options).collect()]
        assert sorted(got) == sorted(plain.collocations(rows, **options))
    assert phrases.collocations(odd.filter("false")).count() == 0


def test_phrases_that_share_a_fingerprint_are_counted_apart(spark, monkeypatch):
    """With fingerprints of two bits nearly all runs collide."""
    texts = ["a b c a b . c d a b", "b a b a b ; d d d", "e f g h . a b c"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("x"))
    monkeypatch.setattr(phrases, "mixed", lambda x: x & np.uint64(3))
    got = [tuple(r)[:8] for r in phrases.collocations(docs, least=5).collect()]
    assert sorted(got) == sorted(plain.collocations([(0, "x", t) for t in texts], least=5)) and got


def test_fingerprints_do_not_depend_on_the_place():
    words = np.random.RandomState(1).randint(0, 2**63, 50, np.int64).astype(np.uint64)
    twice = np.concatenate([words, words[:7], words])
    for size in (1, 2, 3, 5):
        prints = phrases.fingerprints(twice, size, 9)
        assert (prints[: 51 - size] == prints[57 : 108 - size]).all()
        assert len(set(prints[: 51 - size])) == 51 - size
    assert not len(phrases.fingerprints(words[:2], 3, 9))


def test_scores_beyond_64_bits(spark, monkeypatch):
    huge = 3_000_000_000
    counts = spark.createDataFrame(
        [("x", 0, None, 9 * huge, None), ("x", 1, "a", huge + 7, 1), ("x", 1, "b", huge + 9, 1), ("x", 2, "a b", huge, 1)],
        "lang string, size int, phrase string, n long, doc long",
    )
    monkeypatch.setattr(phrases, "count_phrases", lambda *a: counts)
    row = phrases.collocations(counts).first()
    assert row["score"] == 1_000_000 * huge * huge // ((huge + 7) * (huge + 9))


def components_of(frame):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect())


def test_minhash_of_a_table(spark, sf_dir, documents):
    want = plain.jaccard([(d[0], d[4]) for d in documents], 5, 85)
    got = components_of(QUERIES["op13_minhash"](spark, sf_dir))
    assert got == sorted((i, n, c, c == i) for i, (n, c) in want.items())
    assert any(c != i for i, (_, c) in want.items())


def test_minhash_family_around_one_text(spark):
    """Copies of one text link with it and not with each other, and some only with a copy."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(0, base)]
    for i in range(1, 150):
        changed = list(rows[rng.randrange(len(rows))][1] if i % 5 == 0 else base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            changed[rng.randrange(len(changed))] = f"x{rng.randrange(10**6)}"
        rows.append((i, changed))
    rows = [(1000 - i, " ".join(w)) for i, w in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain.jaccard(rows, 5, 85)
    assert components_of(minhash.minhash_components(docs, 5, 85)) == sorted((i, n, c, c == i) for i, (n, c) in want.items())
    assert 1 < len({c for _, c in want.values()}) < 150


def test_minhash_of_odd_rows(odd):
    found = minhash.minhash_components(odd.filter("doc_id < 100 OR doc_id IS NULL"), 5, 85)
    rows = sorted((tuple(r)[:4] for r in found.collect()), key=repr)
    assert rows == sorted(
        [
            (1, 1, 1, True),
            (2, 1, 2, True),
            (2, 1, 2, True),
            (None, 0, None, True),
            (None, 1, None, True),
            (5, 0, 5, True),
            (6, rows[[r[0] for r in rows].index(6)][1], 6, True),
            (7, rows[[r[0] for r in rows].index(7)][1], 6, False),
            (8, 0, 8, True),
            (9, 1, 9, True),
        ],
        key=repr,
    )
    assert minhash.minhash_components(odd.filter("false")).count() == 0


def test_posterior_prunes_what_cannot_reach_the_threshold():
    for compared in (32, 64, 96, 128):
        most = minhash.most_unequal(compared, 85, 1e-7)
        equal = compared - most
        rng = np.random.RandomState(3)
        # The posterior by simulation, one step to either side.
        above = lambda m: (rng.beta(m + 1, compared - m + 1, 400_000) >= 0.85).mean()
        assert above(equal - 1) < 1e-5 and above(equal + 12) > 1e-5
    assert minhash.most_unequal(32, 85, 1e-7) >= minhash.most_unequal(32, 85, 1e-3)


def test_sketch_never_exceeds_the_difference():
    rng = np.random.RandomState(4)
    for _ in range(50):
        a = np.unique(rng.randint(0, 2**62, 200).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.rand(len(a)) < 0.9], rng.randint(0, 2**62, 20).astype(np.uint64)]))
        bits = sum(int(x).bit_count() for x in (minhash.odd_cells(a) ^ minhash.odd_cells(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))
