"""Substring dedup: passages that recur in a document with a smaller id are cut out."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import gram_hashes, in_slices, rows_of, saved, texts, word_hashes, words_of

WINDOW, PHRASE = 50, 8
#: Text that one automaton is compiled for and streamed over, in characters.
SHARD_CHARS = 1 << 20
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, in a logarithmic number of steps."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(words: list[bytes], window: int = WINDOW, phrase: int = PHRASE) -> list[int]:
    """A place of each phrase that is the least, by hash, in some window.

    Equal windows have the same least phrase, so whatever recurs shares one of these.
    """
    if len(words) < window:
        return []
    hashes = gram_hashes(word_hashes(words), phrase)
    least = np.unique(sliding_min(hashes, window - phrase + 1))
    chosen = np.flatnonzero(np.isin(hashes, least))
    _, first = np.unique(hashes[chosen], return_index=True)
    return chosen[first].tolist()


def compiled(phrases: set[str]) -> ahocorasick.Automaton | None:
    """An automaton of phrases with a space on either side, so that it matches whole words."""
    if not phrases:
        return None
    automaton = ahocorasick.Automaton()
    for p in phrases:
        automaton.add_word(f" {p} ", len(p) + 1)
    automaton.make_automaton()
    return automaton


def occurrences(automaton: ahocorasick.Automaton, words: list[str]) -> np.ndarray:
    """Places, in words, at which phrases of the automaton begin."""
    ends = [end - length for end, length in automaton.iter(f" {' '.join(words)} ")]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return np.searchsorted(np.cumsum(lengths) - lengths, np.unique(ends))


def touched_windows(places: np.ndarray, n_words: int, window: int = WINDOW, phrase: int = PHRASE) -> np.ndarray:
    """Starts of the windows that hold a phrase which begins at one of the places."""
    change = np.zeros(n_words + 2, np.int64)
    np.add.at(change, np.maximum(places - (window - phrase), 0), 1)
    np.add.at(change, places + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: max(n_words - window + 1, 0)] > 0)


def _shards(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    sizes = frame["text"].str.len().to_numpy()
    shard = np.cumsum(sizes) // SHARD_CHARS
    for _, part in frame.groupby(shard, sort=True):
        yield part


def _survey(window: int, phrase: int):
    def survey(batches):
        for b in batches:
            rows = []
            for t in b["text"]:
                words = words_of(t)
                at = anchors(words, window, phrase)
                rows.append(
                    (
                        len(words),
                        hashlib.sha256(b" ".join(words)).hexdigest(),
                        [b" ".join(words[p : p + phrase]).decode("utf-8", "surrogatepass") for p in at],
                    )
                )
            n, sha, phrases = zip(*rows, strict=True) if rows else ((), (), ())
            yield pd.DataFrame(
                {"doc_id": b["doc_id"].astype("Int64"), "n_words": n, "sha": sha, "phrases": phrases}
            ).astype({"n_words": "int64", "sha": object, "phrases": object})

    return survey


def _locate(window: int, phrase: int):
    """Stream each shard's documents through the automaton of the phrases that recur in it."""

    def locate(batches):
        for b in batches:
            for part in _shards(b):
                automaton = compiled({p for own in part["phrases"] for p in own})
                rows = []
                for doc_id, t in zip(part["doc_id"], part["text"], strict=True):
                    raw = words_of(t)
                    words = [w.decode("utf-8", "surrogatepass") for w in raw]
                    starts = touched_windows(occurrences(automaton, words), len(words), window, phrase)
                    if len(starts):
                        hashes = gram_hashes(word_hashes(raw), window)[starts].astype(np.int64)
                        rows.append((doc_id, hashlib.sha256(b" ".join(raw)).hexdigest(), starts, hashes))
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "sha", "starts", "hashes"])

    return locate


def _cut(window: int, with_text: bool):
    def cut(batches):
        for b in batches:
            rows = []
            for doc_id, t, sha, starts in zip(b["doc_id"], b["text"], b["sha"], b["starts"], strict=True):
                words = words_of(t)
                if hashlib.sha256(b" ".join(words)).hexdigest() != sha:
                    continue  # another text under the same id
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, np.asarray(starts) + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                rows.append((doc_id, sha, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if with_text else None))
            yield pd.DataFrame(rows, columns=["doc_id", "sha", "cut", "cut_sha", "cut_text"]).astype(
                {"doc_id": "int64", "cut": "int64"}
            )

    return cut


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    phrase: int = PHRASE,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text``).

    ``kept_text`` is null where nothing was removed. Words are runs without ASCII white space. A word goes if it is in a run of ``window`` words
    that also starts in a document with a smaller id; what is left is joined by single spaces.

    1. *Confirm*. Of each window, the phrase of ``phrase`` words with the least hash speaks for it.
       Phrases are counted as text over all documents; those of two documents or more recur. Copies
       of a whole document count once, whatever the size of their group, and are settled apart.
    2. *Compile and stream*. Documents with a recurring phrase are dealt into shards; a shard
       compiles an Aho-Corasick automaton of the phrases that recur in it and streams its
       documents to find every place of every such phrase. An automaton is bounded by the text of its shard, and a phrase that a
       third of all documents share is one entry of each.
    3. Windows around those places are grouped by a 64-bit hash, reduced to the smallest id before
       they are shuffled, and a window with a smaller id elsewhere is cut out.

    A null or empty text has no words. A null id takes no part: it removes nothing and loses
    nothing. Rows with the same id do not remove each other's words. An empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col)
    survey = saved(
        in_slices(
            rows, _survey(window, phrase), "doc_id long, n_words long, sha string, phrases array<string>"
        ),
        "phrase-survey",
    )
    # A whole document is known by the hash of its words; its first copy stands for all.
    distinct = (
        survey.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
        .groupBy("sha")
        .agg(F.min("doc_id").alias("first_id"), F.first("phrases").alias("phrases"))
    )
    spoken = distinct.select(F.col("first_id").alias("doc_id"), F.explode("phrases").alias("phrase"))
    recurring = (
        spoken.groupBy("phrase")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("phrase")
    )
    wanted = spoken.join(recurring, "phrase").groupBy("doc_id").agg(F.collect_set("phrase").alias("phrases"))
    active = saved(rows_of(rows, saved(wanted, "phrase-wanted")), "phrase-active")
    windows = saved(
        in_slices(
            active, _locate(window, phrase), "doc_id long, sha string, starts array<int>, hashes array<bigint>"
        ),
        "phrase-windows",
    )
    located = windows.select(
        "doc_id", "sha", F.explode(F.arrays_zip("starts", "hashes")).alias("w")
    ).select("doc_id", "sha", F.col("w.starts").alias("start"), F.col("w.hashes").alias("hash"))
    earliest = (
        located.groupBy("hash")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("hash", "low")
    )
    hits = (
        located.join(earliest, "hash")
        .filter("doc_id > low")
        .groupBy("doc_id", "sha")
        .agg(F.collect_set("start").alias("starts"))
    )
    cut = saved(
        in_slices(
            active.select("doc_id", "text").join(hits, "doc_id"),
            _cut(window, with_text),
            "doc_id long, sha string, cut long, cut_sha string, cut_text string",
        ),
        "phrase-cut",
    ).dropDuplicates(["doc_id", "sha"])
    if not with_text:
        cut = cut.drop("cut_text")
    firsts = (
        survey.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
        .groupBy("sha")
        .agg(F.min("doc_id").alias("first_id"))
    )
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    base = survey.select("doc_id", "n_words", "sha").join(firsts, "sha", "left").withColumn("copy", copy)
    settled = base.join(cut, ["doc_id", "sha"], "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY_SHA)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        *([F.when(F.col("copy"), F.lit("")).otherwise(F.col("cut_text")).alias("kept_text")] if with_text else []),
    )
    return settled
