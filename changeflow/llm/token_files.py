"""Token files: one zstandard frame a document, a trailing seek table with checksums.

A file is

* the frames, in order of the ids; each holds one document's token ids, little-endian, two or
  four bytes each, and can be decompressed without the others;
* a skippable frame (magic 0x184D2A5D) with the width of an id and the documents' ids;
* the seek table of the public seekable format (skippable frame, magic 0x184D2A5E): for each
  frame its compressed size, its size and the low four bytes of its XXH64; then the number of
  frames, a flag byte and the magic 0x8F92EAB1.

Any zstandard tool decompresses the whole file; a reader that wants a few documents reads the
end of the file and then only their frames.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import in_slices, saved, texts
from changeflow.llm.tokens import default_tokenizer, encoder_for, largest_id
from changeflow.sources.workspace import workspace

INDEX_MAGIC, TABLE_MAGIC, END_MAGIC, CHECKED = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80
MANIFEST = "shard int, file string, n_docs long, n_ids long"


def _open(uri: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


class TokenFileWriter:
    """Writes documents one by one to an open binary stream; keeps 20 bytes a document."""

    def __init__(self, stream, width: int, level: int = 3):
        self.stream, self.width = stream, width
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.entries, self.ids, self.known = bytearray(), [], []

    def add(self, doc_id: int | None, data: bytes) -> None:
        frame = self.compressor.compress(data)
        if len(data) >= 1 << 30:
            raise ValueError(f"document {doc_id} has more than 1 GiB of ids; a frame cannot hold it")
        self.stream.write(frame)
        self.entries += struct.pack("<III", len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
        self.ids.append(doc_id or 0)
        self.known.append(doc_id is not None)

    def close(self) -> None:
        n = len(self.ids)
        index = struct.pack("<BI", self.width, n) + np.array(self.ids, "<i8").tobytes()
        index += np.packbits(np.array(self.known, bool)).tobytes()
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = bytes(self.entries) + struct.pack("<IBI", n, CHECKED, END_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class TokenFile:
    """Reads the end of a file, then only the frames that are asked for."""

    def __init__(self, stream):
        self.stream = stream
        stream.seek(0, io.SEEK_END)
        size = stream.tell()
        stream.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != END_MAGIC or not flags & CHECKED:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = size - 9 - 12 * n - 8
        stream.seek(table_at)
        if struct.unpack("<II", stream.read(8)) != (TABLE_MAGIC, 12 * n + 9):
            raise ValueError("the seek table does not begin where it should")
        entries = np.frombuffer(stream.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = entries.T
        self.ends = np.cumsum(self.packed)
        frames = int(self.ends[-1]) if n else 0
        stream.seek(frames)
        magic, length = struct.unpack("<II", stream.read(8))
        if magic != INDEX_MAGIC or frames + 8 + length != table_at:
            raise ValueError("the frames do not end at the index")
        index = stream.read(length)
        self.width, _ = struct.unpack("<BI", index[:5])
        known = np.unpackbits(np.frombuffer(index[5 + 8 * n :], np.uint8), count=n)
        self.doc_ids = [int(i) if k else None for i, k in zip(np.frombuffer(index[5 : 5 + 8 * n], "<i8"), known, strict=True)]
        self.firsts = np.cumsum(self.sizes // self.width) - self.sizes // self.width

    def read(self, place: int) -> bytes:
        """Ids of the document at a place, four bytes each; raises if the checksum differs."""
        self.stream.seek(int(self.ends[place] - self.packed[place]))
        frame = self.stream.read(int(self.packed[place]))
        data = zstandard.ZstdDecompressor().decompress(frame, max_output_size=int(self.sizes[place]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[place]:
            raise ValueError(f"checksum of frame {place} differs")
        return data if self.width == 4 else np.frombuffer(data, f"<u{self.width}").astype("<u4").tobytes()


def _writer(path: str, tokenizer: str, end_id: int, largest: int) -> Callable:
    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = writer = None
        n_ids = 0
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                width = 2 if max(largest, end_id) < 1 << 16 else 4
                encoder = encoder_for(tokenizer, width)
                end = np.array([end_id], encoder.kind).tobytes()
                # A name of its own for each attempt: the manifest lists the one that counts.
                part = TaskContext.get().partitionId()
                file = f"{path}/tokens-{part:05d}-{uuid.uuid4().hex}.zst"
                system, place = _open(file)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(place, compression=None)
                writer = TokenFileWriter(out, width)
            ids = batch["doc_id"].astype("Int64")
            for doc_id, data in zip(ids, encoder.encode(batch["text"].tolist()), strict=True):
                data += end
                n_ids += len(data) // width
                writer.add(None if doc_id is pd.NA else int(doc_id), data)
        if writer is not None:
            writer.close()
            out.close()
            yield pd.DataFrame({"shard": [part], "file": [file], "n_docs": [len(writer.ids)], "n_ids": [n_ids]})

    return write


def write_token_files(
    docs: DataFrame,
    path: str | None = None,
    tokenizer: str | None = None,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text, append ``end_id`` and write the files in ascending order of the ids.

    Returns the manifest: ``shard, file, n_docs, n_ids``, one row a file. The order of shards is
    the order of ids; null ids come first, rows with equal ids are ordered by a hash of their
    text. A null or empty text has the end id only. An empty table writes no file. ``path`` must
    be a place that all executors reach, with a file system that Arrow knows; by default it is
    a new folder below the shared one. A task that is repeated writes another file, and the
    manifest has the file of the attempt that Spark committed.
    """
    path = path or workspace(docs.sparkSession, "token-files")
    tokenizer = tokenizer or default_tokenizer()
    largest = largest_id(tokenizer)
    rows = texts(docs, id_col, text_col)
    ties = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id"), ties).sortWithinPartitions(F.col("doc_id"), ties)
    return saved(
        in_slices(ordered, _writer(path, tokenizer, end_id, largest), MANIFEST), "token-manifest"
    )


def _whole(doc_ids: list, starts: np.ndarray, ids: list[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "start": starts, "ids": ids})


def _digest(doc_ids: list, starts: np.ndarray, ids: list[bytes]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "doc_id": pd.array(doc_ids, "Int64"),
            "start": starts,
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_crc32": [zlib.crc32(x) for x in ids],
        }
    )


def _reader(wanted: frozenset | None, made: Callable) -> Callable:
    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, before in zip(batch["file"], batch["before"], strict=True):
                system, place = _open(uri)
                with system.open_input_file(place) as stream:
                    file = TokenFile(stream)
                    chosen = [i for i, d in enumerate(file.doc_ids) if wanted is None or d in wanted]
                    for k in range(0, len(chosen), 500):
                        part = chosen[k : k + 500]
                        yield made(
                            [file.doc_ids[i] for i in part],
                            file.firsts[part] + before,
                            [file.read(i) for i in part],
                        )

    return read


def _read(manifest: DataFrame, wanted: frozenset | None, made: Callable, schema: str) -> DataFrame:
    files = manifest.count()  # one row a file
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    return starts.repartition(max(1, files)).mapInPandas(_reader(wanted, made), schema)


def read_token_files(manifest: DataFrame, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Documents of the files: ``doc_id, start, ids``; ids with four bytes each.

    ``start`` counts the ids of all documents before, over all files. With ``doc_ids``, a list
    short enough to hand to every task, only their frames are read and decompressed. A frame
    that differs from its checksum is an error.
    """
    wanted = None if doc_ids is None else frozenset(doc_ids)
    return _read(manifest, wanted, _whole, "doc_id long, start long, ids binary")


def token_digests(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files."""
    return _read(manifest, None, _digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
