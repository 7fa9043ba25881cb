"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import gram_hashes, in_slices, mixed, quoted, texts

WORD = re.compile(r"[^\W_]+")
#: Text of a benchmark that is handed to every task at a time, in bytes.
BLOCK_BYTES = 8 << 20
RESULT = "doc_id long, row_text string, items array<long>, coverage double"
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def tokens(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return WORD.findall(text.lower())


def tiles(pattern: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(place in pattern, place in text, length)`` of each tile.

    Matches of unmarked tokens are sought with a running Karp-Rabin hash of ``size`` tokens and
    lengthened as far as they go. One that is more than twice as long raises the size; otherwise
    the matches found are marked, longest first, as far as nothing in them is marked yet, and
    the size falls to the least length. Negative tokens of the text match nothing.
    """
    free_p, free_t = [True] * len(pattern), [t >= 0 for t in text]
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(pattern), 20))
    while True:
        matches: dict[int, list[tuple[int, int]]] = defaultdict(list)
        longest = 0
        places: dict[int, list[int]] = defaultdict(list)
        for at, value in _running(text, free_t, size):
            places[value].append(at)
        for p, value in _running(pattern, free_p, size):
            for t in places.get(value, ()):
                k = 0
                while (
                    p + k < len(pattern)
                    and t + k < len(text)
                    and pattern[p + k] == text[t + k]
                    and free_p[p + k]
                    and free_t[t + k]
                ):
                    k += 1
                if k >= size:
                    matches[k].append((p, t))
                    longest = max(longest, k)
        if longest > 2 * size:
            size = longest
            continue
        for k in sorted(matches, reverse=True):
            for p, t in matches[k]:
                if all(free_p[p : p + k]) and all(free_t[t : t + k]):
                    found.append((p, t, k))
                    free_p[p : p + k] = free_t[t : t + k] = [False] * k
        # What is left of a match that was partly covered is looked for again at the same size.
        again = any(
            any(all(free_p[p + i : p + i + size]) and all(free_t[t + i : t + i + size]) for i in range(k - size + 1))
            for k, at in matches.items()
            for p, t in at
        )
        if again:
            continue
        if size == least:
            return sorted(found)
        size = max(least, size // 2)


def _running(values: list[int], free: list[bool], size: int):
    """Place and hash of each run of ``size`` unmarked tokens, the hash moved on token by token."""
    top = pow(_BASE, size, 1 << 64)
    value = length = 0
    for i, v in enumerate(values):
        if not free[i]:
            value = length = 0
            continue
        value = (value * _BASE + v + 1) & _MASK
        length += 1
        if length > size:
            value = (value - (values[i - size] + 1) * top) & _MASK
        if length >= size:
            yield i - size + 1, value


class Benchmark:
    """Items of one block: their tokens as numbers and the items of each seed."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.words: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        for item_id, text in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in tokens(text)]
            if ids:
                self.items.append((item_id, ids))
        self.seeds = []  # for each seed length: sorted hashes, and the item of each
        for size in sorted({min(least, len(ids)) for _, ids in self.items}):
            pairs = {
                (int(h), k)
                for k, (_, ids) in enumerate(self.items)
                if min(least, len(ids)) == size
                for h in _seed_hashes(np.array(ids, np.int64), size)
            }
            ordered = sorted(pairs)
            self.seeds.append(
                (size, np.array([h for h, _ in ordered], np.uint64), np.array([k for _, k in ordered], np.int64))
            )

    def coverage(self, text: str, least: int, threshold: float) -> dict[int, float]:
        """Share of each touched item's tokens that tiles in the text cover."""
        get = self.words.get
        ids = np.array([get(w, -1) for w in tokens(text)], np.int64)
        known = ids >= 0
        out = {}
        for size, hashes, owners in self.seeds:
            if len(ids) < size or not known.any():
                continue
            whole = np.lib.stride_tricks.sliding_window_view(known, size).all(1)
            places = np.flatnonzero(whole)
            if not len(places):
                continue
            seeds = _seed_hashes(ids, size)[places]
            low, high = np.searchsorted(hashes, seeds, "left"), np.searchsorted(hashes, seeds, "right")
            touched: dict[int, list[int]] = defaultdict(list)
            for at, a, b in zip(places[high > low].tolist(), low[high > low], high[high > low], strict=True):
                for k in owners[a:b].tolist():
                    touched[k].append(at)
            for k, at in touched.items():
                item_id, pattern = self.items[k]
                covered = np.zeros(len(ids) + 1, bool)
                for p in at:
                    covered[p : p + size] = True
                if covered.sum() < threshold * len(pattern):
                    continue  # tiles lie in covered tokens, so these are too few
                spots = np.flatnonzero(covered)
                part = []
                for i, p in enumerate(spots.tolist()):
                    if i and p != spots[i - 1] + 1:
                        part.append(-1)
                    part.append(int(ids[p]))
                out[item_id] = sum(n for _, _, n in tiles(pattern, part, size)) / len(pattern)
        return out


def _seed_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    return gram_hashes(mixed(ids.astype(np.uint64) + np.uint64(1)), size)


def _tiler(block, least: int, threshold: float) -> Callable:
    def tile(batches):
        bench = Benchmark(block.value, least)
        for b in batches:
            items, most = [], []
            for text, old, best in zip(b["row_text"], b["items"], b["coverage"], strict=True):
                found = bench.coverage(text, least, threshold)
                items.append(sorted({*old, *(i for i, c in found.items() if c >= threshold)}))
                most.append(max([best, *found.values()]))
            yield pd.DataFrame(
                {"doc_id": b["doc_id"].astype("Int64"), "row_text": b["row_text"], "items": items, "coverage": most}
            ).astype({"coverage": float})

    return tile


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = 5,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per input row: ``doc_id, contaminated, items, coverage, text_mark``.

    ``items`` are the benchmark items of whose tokens tiles in the text cover at least
    ``threshold``; ``coverage`` is the largest share among the items that were tiled (0 if none). A
    tile is a run of at least ``least`` tokens, in any order in the document, so that a passage
    whose sentences were moved about is found too. An item with fewer tokens must occur whole; an
    item without tokens is never found. ``text_mark`` is the XXH64 of the text.

    Seeds of ``least`` tokens that a document shares with an item choose the pairs that are
    tiled. The benchmark is dealt into blocks of about ``block_bytes`` by a hash of the item, and
    the blocks are handed to the tasks one after the other, so memory is bounded for any
    benchmark; documents stream past them without a shuffle.

    Null texts count as empty; items with a null id or text are left out; repeated items and rows
    are judged each. An empty table or benchmark is no error.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        quoted(item_col).cast("long").alias("item_id"), quoted(item_text_col).cast("string").alias("text")
    ).dropna()
    size = items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    blocks = -(-size // block_bytes)
    found = texts(docs, id_col, text_col).select(
        "doc_id",
        F.col("text").alias("row_text"),
        F.array().cast("array<bigint>").alias("items"),
        F.lit(0.0).alias("coverage"),
    )
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for k in range(blocks):
        block = [(r["item_id"], r["text"]) for r in items.filter(block_of == k).collect()]
        found = in_slices(found, _tiler(spark.sparkContext.broadcast(block), least, threshold), RESULT)
    return found.select(
        "doc_id",
        (F.size("items") > 0).alias("contaminated"),
        "items",
        "coverage",
        F.xxhash64("row_text").alias("text_mark"),
    )
