"""Collocations: frequent phrases found by fingerprints, counted exactly, scored by their parts."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import filter_of, in_slices, mixed, passes, quoted, rows_of, saved

#: Grams that a task gathers before it sends their counts on.
GATHERED = 1 << 19
#: Words a task remembers the hash of, before it starts anew.
KNOWN = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: What ends a piece, and the white space within one, as bytes; the former become line ends.
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


class _Words(dict):
    """Words by number and hash; ends of pieces are number 0 and what is no word number 1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})
        self.words, self.hashes, self.checks = [b"\n", b""], [0, 0], [0, 0]

    def __missing__(self, word):
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        self.checks.append(xxhash.xxh3_64_intdigest(word, seed=1))
        return number


@lru_cache(maxsize=4)
def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2**64."""
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base)]), dtype=np.uint64)[:n]


def fingerprints(hashes: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Rabin-Karp fingerprints of all runs of ``size`` words, from prefix sums of a polynomial.

    ``hashes[j]`` times ``_BASE**j`` summed up to a place, less the sum before a run, is the run's
    polynomial times ``_BASE`` to the run's start, which the inverse power takes away again.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # Powers for the next power of two many words serve for all lengths up to it.
    some = 1 << len(hashes).bit_length()
    prefix = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_BASE, some)[: len(hashes)], out=prefix[1:])
    return mixed((prefix[size:] - prefix[:n]) * powers(_INVERSE, some)[:n] + np.uint64(salt))


def _salt(lang: str, size: int) -> int:
    """Sets phrases of different languages and lengths apart."""
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=size)


class Chunk:
    """Words of some texts of one language, one after the other."""

    def __init__(self, lang: str):
        self.lang, self.known = lang, _Words()
        self.numbers, self.docs, self.size = [], [], 0

    def add(self, doc_id: int, text: str) -> None:
        raw = text.encode("utf-8", "surrogatepass").lower().translate(_ENDS)
        parts = raw.replace(b"\n", b" \n ").split(b" ")
        numbers = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        self.numbers += [numbers[numbers != 1], np.zeros(1, np.int64)]
        self.docs.append((doc_id, len(self.numbers[-2]) + 1))
        self.size += len(parts)

    def full(self) -> bool:
        return self.size >= GATHERED or len(self.known) >= KNOWN

    def close(self) -> None:
        self.numbers = np.concatenate([np.zeros(0, np.int64), *self.numbers])
        self.hashes = np.array(self.known.hashes, np.uint64)[self.numbers]
        self.checks = np.array(self.known.checks, np.uint64)[self.numbers]
        self.ends = np.concatenate([[0], np.cumsum(self.numbers == 0)])

    def total(self) -> int:
        return int((self.numbers != 0).sum())

    def within(self, size: int) -> np.ndarray:
        """Starts of the runs of ``size`` words that no end of a piece is in."""
        n = max(len(self.numbers) - size + 1, 0)
        return np.flatnonzero(self.ends[size : size + n] == self.ends[:n])

    def prints(self, size: int) -> np.ndarray:
        return fingerprints(self.hashes, size, _salt(self.lang, size))

    def second_prints(self, size: int) -> np.ndarray:
        """Fingerprints of other hashes of the words, which tell runs apart that share the first."""
        return fingerprints(self.checks, size, _salt(self.lang, size))

    def doc_of(self, starts: np.ndarray) -> np.ndarray:
        ids, lengths = np.array([d for d, _ in self.docs]), np.array([n for _, n in self.docs])
        return ids[np.searchsorted(np.cumsum(lengths), starts, side="right")]

    def text_of(self, start: int, size: int) -> str:
        words = [self.known.words[i] for i in self.numbers[start : start + size]]
        return b"\x20".join(words).decode("utf-8", "surrogatepass")


def _chunks(batches):
    """Chunks out of frames with ``doc_id, lang, text``, whatever order languages come in."""
    open_ones = {}
    for b in batches:
        for doc_id, lang, text in zip(b["doc_id"], b["lang"], b["text"], strict=True):
            chunk = open_ones.get(lang) or open_ones.setdefault(lang, Chunk(lang))
            chunk.add(doc_id, text)
            if chunk.full() or sum(c.size for c in open_ones.values()) >= 2 * GATHERED:
                largest = max(open_ones, key=lambda name: open_ones[name].size)
                done = open_ones.pop(largest)
                done.close()
                yield done
    for chunk in open_ones.values():
        chunk.close()
        yield chunk


def _promising(chunk: Chunk, size: int, bits) -> np.ndarray:
    """Starts of runs of ``size`` words of which both runs that are one word shorter are frequent."""
    starts = chunk.within(size)
    if bits is None or size == 1 or not len(starts):
        return starts
    passed = passes(bits.value, chunk.prints(size - 1))
    return starts[passed[starts] & passed[starts + 1]]


def _count_prints(sizes, bits):
    """Fingerprints of runs with their counts, a second fingerprint, and a document that holds one.

    As runs of no words, all words of a language are counted.
    """

    def count(batches):
        for chunk in _chunks(batches):
            for size in sizes:
                if size == 0:
                    mark = np.array([_salt(chunk.lang, 0)], np.uint64).astype(np.int64)
                    yield pd.DataFrame({"print": mark, "n": [chunk.total()], "doc": [chunk.docs[0][0]], "second": mark})
                    continue
                starts = _promising(chunk, size, bits)
                prints, first, n = np.unique(chunk.prints(size)[starts], return_index=True, return_counts=True)
                if len(prints):
                    out = {"print": prints.astype(np.int64), "n": n, "doc": chunk.doc_of(starts[first])}
                    yield pd.DataFrame(out | {"second": chunk.second_prints(size)[starts[first]].astype(np.int64)})

    return count


def _write_out(sizes):
    """The words of runs whose fingerprints are wanted of the documents.

    Documents of a frame are looked at together; a run comes once for each second fingerprint.
    """

    def write(batches):
        for b in batches:
            rows = []
            for lang, part in b.groupby("lang"):
                chunk = Chunk(lang)
                for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                    chunk.add(doc_id, text)
                chunk.close()
                wanted = np.unique(np.concatenate([np.asarray(w, np.int64) for w in part["prints"]])).view(np.uint64)
                wanted = np.sort(wanted)
                if 0 in sizes and np.isin(np.uint64(_salt(lang, 0)), wanted):
                    rows.append((np.uint64(_salt(lang, 0)).astype(np.int64), lang, 0, None))
                for size in filter(None, sizes):
                    starts = chunk.within(size)
                    prints = chunk.prints(size)[starts]
                    met = wanted[np.minimum(np.searchsorted(wanted, prints), len(wanted) - 1)] == prints
                    starts, prints = starts[met], prints[met]
                    both = prints ^ mixed(chunk.second_prints(size)[starts])
                    for i in np.unique(both, return_index=True)[1]:
                        rows.append((prints[i].astype(np.int64), lang, size, chunk.text_of(starts[i], size)))
            if rows:
                yield pd.DataFrame(rows, columns=["print", "lang", "size", "phrase"]).astype({"size": "int32"})

    return write


def _count_phrases(sizes, bits):
    """Runs whose fingerprint the filter lets through, by their words, with counts."""

    def count(batches):
        for chunk in _chunks(batches):
            for size in sizes:
                starts = chunk.within(size)
                prints = chunk.prints(size)[starts]
                passed = passes(bits.value, prints)
                starts, prints = starts[passed], prints[passed]
                if not len(starts):
                    continue
                # Runs are told apart by the numbers of their words, so no two share a count.
                codes = chunk.numbers[starts]
                for k in range(1, size):
                    codes = np.unique(codes, return_inverse=True)[1] * len(chunk.known) + chunk.numbers[starts + k]
                _, first, n = np.unique(codes, return_index=True, return_counts=True)
                phrases = [chunk.text_of(s, size) for s in starts[first]]
                out = {"print": prints[first].astype(np.int64), "size": size, "phrase": phrases, "n": n}
                out = pd.DataFrame(out | {"doc": chunk.doc_of(starts[first])}).astype({"size": "int32"})
                out.insert(1, "lang", chunk.lang)
                yield out

    return count


def _by_text(rows: DataFrame, frequent: DataFrame, sizes) -> DataFrame:
    """``print, lang, size, phrase``: the words of frequent fingerprints.

    They are read in the first and the last document that a fingerprint points to; no other
    document is looked at.
    """
    pointed = frequent.select("print", F.explode(F.array("doc", "last_doc")).alias("doc_id")).distinct()
    # A document has no more prints than runs of words.
    wanted = pointed.groupBy("doc_id").agg(F.collect_list("print").alias("prints"))
    found = rows_of(rows, saved(wanted, "phrase-pointers"))
    schema = "print long, lang string, size int, phrase string"
    return in_slices(found.select("doc_id", "lang", "text", "prints"), _write_out(sizes), schema)


def _exact(rows: DataFrame, least: int, sizes, bits) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of some sizes with their counts, and their fingerprints."""
    spark = rows.sparkSession
    counted = in_slices(rows, _count_prints(sizes, bits), "print long, n long, doc long, second long")
    # Tasks have counted already; once more before the shuffle would only widen the rows.
    totals = counted.repartition("print").groupBy("print").agg(
        F.sum("n").alias("n"),
        F.min("doc").alias("doc"),
        F.max("doc").alias("last_doc"),
        (F.min("second") < F.max("second")).alias("shared"),
    )
    frequent = saved(totals.filter(F.col("n") >= least), "phrase-prints")
    texts = _by_text(rows, frequent, sizes).groupBy("print").agg(
        *[F.min(c).alias(c) for c in ("lang", "size", "phrase")],
        (F.min(F.struct("lang", "size", "phrase")) < F.max(F.struct("lang", "size", "phrase"))).alias("unlike"),
    )
    known = saved(frequent.join(texts, "print"), "phrase-texts")
    several = F.col("shared") | F.col("unlike")
    found = known.filter(~several).select("lang", "size", "phrase", "n", "doc")
    apart = known.filter(several).select("print")
    if apart.limit(1).count():
        # Runs that share a fingerprint are counted again by their words.
        again = in_slices(
            rows,
            _count_phrases([size for size in sizes if size], filter_of(spark, apart)),
            "print long, lang string, size int, phrase string, n long, doc long",
        )
        again = again.join(apart, "print", "left_semi").groupBy("lang", "size", "phrase")
        again = again.agg(F.sum("n").alias("n"), F.min("doc").alias("doc")).filter(F.col("n") >= least)
        found = found.unionByName(saved(again, "phrase-apart"))
    return found, frequent


def count_phrases(
    docs: DataFrame, longest: int = 3, least: int = 10, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """``lang, size, phrase, n, doc``: phrases of up to ``longest`` words that occur ``least`` times.

    ``doc`` points to a document that holds the phrase. Row with ``size`` 0 and no phrase: how
    many words a language has, if they are that many. For conventions see ``collocations``.

    Tasks count fingerprints, and a shuffle sums the counts up with pointers to documents that
    hold a run. A run is looked at only if both runs within it that are a word shorter are
    frequent. Frequent fingerprints alone are written out as text, from the documents pointed to.
    Where two such texts differ, or second fingerprints do, runs share a fingerprint; those are
    counted again by their words, so no count is that of two phrases.
    """
    rows = docs.select(
        F.coalesce(quoted(id_col).cast("long"), F.lit(-1)).alias("doc_id"),
        F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )
    found, frequent = None, None
    steps = [(0, 1, 2), *[(size,) for size in range(3, longest + 1)]] if longest > 1 else [(0, 1)]
    for step in steps:
        # What the last step finds needs no filter.
        bits = None if frequent is None else filter_of(rows.sparkSession, frequent)
        exact, frequent = _exact(rows, least, step, bits)
        found = exact if found is None else found.unionByName(exact)
    return found


def _words(phrase: Column) -> Column:
    return F.split(phrase, "\x20")


def _part(words: Column, start, size) -> Column:
    return F.array_join(F.slice(words, start, size), "\x20")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    within: int = 50,
    most: int = 2000,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The ``most`` best phrases of every language: ``lang, rank, phrase, a, l, r, n, score, doc``.

    Texts have A-Z in lower case and are split at ``.,;:!?`` and line ends into pieces, those at
    spaces and tabs into words. Phrases are runs of 2 to ``longest`` words in a piece that occur
    ``least`` times, overlaps included. ``a``, ``l`` and ``r`` count the phrase and the two parts of
    its weakest cut, ``n`` all words of the language; the score is 1,000,000 * a * a / (l * r),
    rounded down, exact at any size. A phrase that stands in a longer one with ``within`` percent
    of its count is left out. Ties go by count, then by the bytes of the phrase. A null language
    is ``und``, a null text is empty, rows with the same id are all counted, ``doc`` is the smallest
    id whose text holds the phrase (-1 for a null id). An empty table gives no rows.
    """
    counts = count_phrases(docs, longest, least, id_col, lang_col, text_col)
    phrases = counts.filter("size > 0")
    several = phrases.filter("size > 1").withColumnRenamed("n", "a").withColumn("words", _words(F.col("phrase")))
    cut = several.select(
        "lang", "phrase", "a", "size", "doc", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cut = cut.select(
        "lang",
        "phrase",
        "a",
        "doc",
        "k",
        _part(F.col("words"), F.lit(1), F.col("k")).alias("first"),
        _part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    cut = saved(cut, "phrase-cuts")
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumns(
        {"top": wide("a") * wide("a") * F.lit(1000000).cast("decimal(7,0)"), "bottom": wide("l") * wide("r")}
    )
    scored = scored.withColumn("score", F.expr("top div bottom"))
    weakest = scored.groupBy("lang", "phrase", "a", "doc").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = several.filter("size > 2").select(
        "lang",
        "a",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda n: F.transform(
                        F.sequence(F.lit(1), F.col("size") - n + 1), lambda s: _part(F.col("words"), s, n)
                    ),
                )
            )
        ).alias("phrase"),
    )
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * within)
    )
    # Best in a part of a language first, so that no task sees all phrases of one.
    best = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    some = some.filter(F.col("rank") <= most)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    totals = counts.filter("size = 0").select("lang", "n")
    return ranked.filter(F.col("rank") <= most).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "doc"
    )
