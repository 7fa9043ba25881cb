"""Best-fit packing of documents into sequences, after fixing what provably cannot be bettered."""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import in_slices, saved, texts
from changeflow.llm.tokens import default_tokenizer, encoder_for

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, place long"
#: A kind of sequence: how many there are, and (length, how many of it) in order.
Kind = tuple[int, list[tuple[int, int]]]


def fix_dominating(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Martello and Toth's reduction; takes what it fixes out of ``counts``.

    From the longest length j down, a set that holds j is fixed if it dominates every other set
    that could: whatever else stood beside j could take the places of the set's members, piece
    by piece, without loss. That holds for

    * j alone, if nothing fits beside it;
    * j and the longest a that fits, if a fills the sequence or no two pieces fit beside j, or
      no two that fit are longer together than a;
    * j, a and the longest b that fits then, if no three fit beside j and of any two that fit
      one is at most as long as b.

    Each step fixes as many equal sets as there are, so the steps follow the number of lengths.
    """
    fixed: list[Kind] = []

    def take(*lengths: int) -> bool:
        need = defaultdict(int)
        for n in lengths:
            need[n] += 1
        times = min(counts.get(n, 0) // k for n, k in need.items())
        if times:
            fixed.append((times, sorted(need.items(), reverse=True)))
            for n, k in need.items():
                counts[n] -= times * k
                if not counts[n]:
                    del counts[n]
        return times > 0

    for j in sorted(counts, reverse=True):
        while counts.get(j):
            room = capacity - j
            counts[j] -= 1
            beside = sorted(n for n, c in counts.items() if c and n <= room)
            least = []  # the three shortest pieces
            for n in beside[:3]:
                least += [n] * min(3, counts[n])
            a = beside[-1] if beside else 0
            two = least[0] + least[1] if len(least) > 1 else capacity + 1
            three = sum(least[:3]) if len(least) > 2 else capacity + 1
            done = ()
            if not beside:
                done = (j,)
            elif a == room or two > room or (two <= a and _best_pair(beside, counts, room) <= a):
                done = (j, a)
            elif three > room:
                counts[a] -= 1
                rest = [n for n in beside if counts[n] and n <= room - a]
                counts[a] += 1
                if rest and _widest_pair(beside, counts, room) <= rest[-1]:
                    done = (j, a, rest[-1])
            counts[j] += 1
            if not done or not take(*done):
                break
    return fixed


def _best_pair(lengths: list[int], counts: dict[int, int], room: int) -> int:
    """The largest sum of pieces that fits, if it is of two; of more pieces, the room itself."""
    if lengths[0] * 3 <= room:
        return room
    best = 0
    for i, n in enumerate(lengths):
        k = bisect.bisect_right(lengths, room - n) - 1
        if k == i and counts[n] < 2:
            k -= 1
        if k >= 0:
            best = max(best, n + lengths[k])
    return best


def _widest_pair(lengths: list[int], counts: dict[int, int], room: int) -> int:
    """The longest that the shorter of two pieces can be which fit together."""
    best = 0
    for i, n in enumerate(lengths):
        longer = n if counts[n] > 1 else (lengths[i + 1] if i + 1 < len(lengths) else room + 1)
        if n + longer <= room:
            best = max(best, n)
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Best fit, longest first, for many equal pieces at a time.

    Open sequences with the same content are one entry. A length goes into the entries with
    the least room that still holds it, as often as it fits; at most one entry is divided for a
    length, so the entries stay within a few times the number of lengths, however many pieces
    there are.
    """
    rooms: dict[int, list[Kind]] = defaultdict(list)
    order: list[int] = []

    def put(room: int, kind: Kind) -> None:
        if not rooms[room]:
            bisect.insort(order, room)
        rooms[room].append(kind)

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            at = bisect.bisect_left(order, n)
            if at == len(order):
                each = capacity // n
                full, some = divmod(left, each)
                if full:
                    put(capacity - each * n, (full, [(n, each)]))
                if some:
                    put(capacity - some * n, (1, [(n, some)]))
                break
            room = order[at]
            times, content = rooms[room].pop()
            if not rooms[room]:
                del order[at]
            each = room // n
            full = min(times, left // each)
            if full:
                put(room - each * n, (full, [*content, (n, each)]))
                left -= full * each
                times -= full
            if times and left and left < each:
                put(room - left * n, (1, [*content, (n, left)]))
                times -= 1
                left = 0
            if times:
                put(room, (times, content))
    return [kind for kinds in rooms.values() for kind in kinds]


def plan_sequences(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Kinds of sequences for a histogram of lengths; its size is bounded by the capacity."""
    left = {n: c for n, c in counts.items() if c}
    return [*fix_dominating(left, capacity), *best_fit(left, capacity)]


def _cutter(tokenizer: str, capacity: int, end_id: int) -> Callable:
    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_for(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        seen = [0] * (capacity + 1)
        task = TaskContext.get().partitionId()
        for batch in batches:
            doc_ids = batch["doc_id"].astype("Int64")
            rows = []
            for doc_id, data in zip(doc_ids, encoder.encode(batch["text"].tolist()), strict=True):
                data += end
                total = len(data) // 4
                start = 0
                for piece in range(-(-total // capacity)):
                    size = (total - 1) % capacity + 1 if piece == 0 else capacity
                    crc = zlib.crc32(data[4 * start : 4 * (start + size)])
                    rows.append((doc_id, piece, start, size, crc, task, seen[size]))
                    seen[size] += 1
                    start += size
            if rows:
                columns = zip(*rows, strict=True)
                names = [c.split()[0] for c in PIECES.split(", ")]
                out = pd.DataFrame(dict(zip(names, columns, strict=True)))
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return cut


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    A document is the ids of its text and then ``end_id``; a null or empty text is that id alone.
    Only a document longer than a sequence is cut; its first piece takes what is left over by full
    sequences. Rows are packed one by one, so repeated and null ids are packed as well. An empty
    table gives no rows.

    What comes to the driver is the number of pieces of each length, at most ``capacity``
    numbers. The plan made from it has a bounded size too: kinds of sequences, each with a count.
    A task numbers its pieces of each length; the counts by task and length, summed up to each
    task, turn that into numbers over all tasks, from which a piece finds its sequence alone.
    Hot lengths are therefore never gathered anywhere.
    """
    rows = texts(docs, id_col, text_col)
    pieces = saved(
        in_slices(rows, _cutter(tokenizer or default_tokenizer(), capacity, end_id), PIECES), "pieces"
    )
    by_task = saved(pieces.groupBy("length", "task").count(), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    lengths, firsts, lasts, each, sequence, offset = [], [], [], [], [], []
    used = defaultdict(int)
    sequences = 0
    for times, content in plan_sequences(counts, capacity):
        at = 0
        for n, k in content:
            lengths.append(n)
            firsts.append(used[n])
            used[n] += times * k
            lasts.append(used[n])
            each.append(k)
            sequence.append(sequences)
            offset.append(at)
            at += n * k
        sequences += times
    order = np.lexsort((firsts, lengths))
    lengths, firsts, each, sequence, offset = (
        np.array(x, np.int64)[order] for x in (lengths, firsts, each, sequence, offset)
    )
    begin = np.searchsorted(lengths, np.arange(capacity + 2))

    def place(batches):
        for b in batches:
            n, index = b["length"].to_numpy(np.int64), b["place"].to_numpy(np.int64)
            slot = np.empty(len(b), np.int64)
            for one in np.unique(n):
                here = n == one
                own = firsts[begin[one] : begin[one + 1]]
                slot[here] = begin[one] + np.searchsorted(own, index[here], "right") - 1
            inside = index - firsts[slot]
            b["sequence_id"] = sequence[slot] + inside // each[slot]
            b["offset"] = offset[slot] + inside % each[slot] * n
            yield b.drop(columns="place")

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["length", "task"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", (F.col("place") + F.col("base")).alias("place")
    )
    return numbered.mapInPandas(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
