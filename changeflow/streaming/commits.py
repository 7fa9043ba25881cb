"""The commit log of a store: which attempt at a batch counts, and what no reader needs any more.

A writer puts its files into a folder of its own, an attempt, and then adds one record to
``commits``. The record is a file that appears under its final name at once and never replaces
another one, so a reader that lists the log sees an attempt with all its files or not at all. What
counts for a batch is the attempt committed last; what counts as base is the one with the most
batches in it. Readers take a ``Snapshot`` first and read only files that it names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: What a record names: a batch with or without dead letters, one of which only those are left, a base.
BATCH, CHANGES, LETTERS, BASE = "batch", "changes", "letters", "base"
#: For how long a file stays after the log has stopped to name it, for readers that are at it.
RETAIN_SECONDS = 7 * 86400


class Commit(NamedTuple):
    """``batch_id`` of a base is the last batch in it; ``at`` is in seconds since 1970."""

    version: int
    kind: str
    batch_id: int
    attempt: str
    at: float


class Snapshot(NamedTuple):
    """A state of a store: its base, and the attempt that counts for every batch, by number.

    ``letters`` are those whose dead letters are there; they outlast the folding of a batch.
    """

    version: int
    base: Commit | None
    batches: tuple[Commit, ...]
    letters: tuple[Commit, ...] = ()

    def after(self, batch_id: int, until: int | None = None) -> list[Commit]:
        return [c for c in self.batches if c.batch_id > batch_id and (until is None or c.batch_id <= until)]


def new_attempt() -> str:
    return uuid.uuid4().hex


class Folder:
    """Files of the shared store, through the file system Spark itself uses for the path."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path
        gateway = spark.sparkContext._gateway
        self._no_options = gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def listed(self, name: str = "") -> list[tuple[str, bool, float]]:
        """Name, whether it is a folder, and time of change of what lies in a folder."""
        try:
            found = self._fs.listStatus(self._at(name))
        except Py4JJavaError as error:
            if "FileNotFoundException" in str(error.java_exception):
                return []
            raise
        return [(f.getPath().getName(), f.isDirectory(), f.getModificationTime() / 1000) for f in found]

    def text(self, name: str) -> str | None:
        """Contents of a small file, ``None`` if it is not there."""
        try:
            stream = self._fs.open(self._at(name))
        except Py4JJavaError as error:
            if "FileNotFoundException" in str(error.java_exception):
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Make a file appear with all its text; false if there is one of that name already."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/_{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
            # Without an option a file of that name is not replaced.
            context.rename(self._at(draft), self._at(f"{folder}/{last}"), self._no_options)
            return True
        except Py4JJavaError as error:
            self.remove(draft)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)


def _line(c: Commit) -> str:
    return json.dumps(c._asdict())


def _read(folder: Folder) -> list[Commit]:
    """All records by version. Records that a clean-up has gathered in one file count once."""
    while True:
        names = sorted(n for n, _, _ in folder.listed("commits") if n.endswith(".json"))
        texts = [folder.text(f"commits/{n}") for n in names]
        if None not in texts:
            lines = {line for text in texts for line in text.splitlines()}
            return sorted(Commit(**json.loads(line)) for line in lines)
        # A clean-up came between listing and reading; what it removed is in a newer file.


def _last_version(folder: Folder) -> int:
    """Files are named after their last record."""
    return max((int(n.split(".")[0]) for n, _, _ in folder.listed("commits") if n.endswith(".json")), default=0)


def commit(spark: SparkSession, path: str, kind: str, batch_id: int, attempt: str) -> int:
    """Make an attempt count; returns the version of the store that has it.

    Writers need no lock: of two that try the same version one goes on to the next.
    """
    folder, version = Folder(spark, path), 0
    while True:
        version = max(version, _last_version(folder)) + 1
        record = Commit(version, kind, batch_id, attempt, time.time())
        if folder.put_new(f"commits/{version:020d}.json", _line(record) + "\n"):
            return version


def _snapshot_of(commits: list[Commit]) -> Snapshot:
    batches = {c.batch_id: c for c in commits if c.kind in (BATCH, CHANGES)}
    letters = {c.batch_id: c for c in commits if c.kind in (BATCH, LETTERS)}
    bases = [c for c in commits if c.kind == BASE]
    base = max(bases, key=lambda c: (c.batch_id, c.version)) if bases else None
    ordered = [tuple(named[b] for b in sorted(named)) for named in (batches, letters)]
    return Snapshot(commits[-1].version if commits else 0, base, *ordered)


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The state of the store now."""
    return _snapshot_of(_read(Folder(spark, path)))


def is_store(spark: SparkSession, path: str) -> bool:
    return _last_version(Folder(spark, path)) > 0


@contextmanager
def held(spark: SparkSession, path: str) -> Iterator[Snapshot]:
    """A snapshot whose files no clean-up removes until the block is left.

    A reader that dies without leaving it holds them for as long as files are retained.
    """
    folder, name = Folder(spark, path), f"held/{uuid.uuid4().hex}.json"
    while True:
        taken = snapshot(spark, path)
        folder.put_new(name, json.dumps({"version": taken.version, "at": time.time()}))
        # A clean-up that did not see the mark yet has been before this.
        if snapshot(spark, path) == taken:
            break
        folder.remove(name)
    try:
        yield taken
    finally:
        folder.remove(name)


def _replaced_at(commits: list[Commit]) -> dict[Commit, float]:
    """When records ceased to be part of the present snapshot; those that are part of it are left out."""
    out, batches, base = {}, {}, None
    for c in commits:
        if c.kind == BASE:
            if base and (c.batch_id, c.version) < (base.batch_id, base.version):
                out[c] = c.at
                continue
            if base:
                out[base] = c.at
            base = c
            for b in [b for b in batches if b <= c.batch_id]:
                out[batches.pop(b)] = c.at
        elif c.kind == LETTERS or (base and c.batch_id <= base.batch_id):
            out[c] = c.at
        else:
            if c.batch_id in batches:
                out[batches[c.batch_id]] = c.at
            batches[c.batch_id] = c
    return out


def needed(spark: SparkSession, path: str, retain_seconds: float = RETAIN_SECONDS) -> list[Commit]:
    """Records whose files some reader may need.

    That is what the present snapshot names, what a held one names, and what was replaced, or
    folded into a base, less than ``retain_seconds`` ago.
    """
    folder, now = Folder(spark, path), time.time()
    commits = _read(folder)
    replaced = _replaced_at(commits)
    keep = {c for c in commits if c not in replaced or now - replaced[c] < retain_seconds}
    marks = [folder.text(f"held/{n}") for n, _, _ in folder.listed("held") if n.endswith(".json")]
    marks = [json.loads(m) for m in marks if m]
    for version in {m["version"] for m in marks if now - m["at"] < max(retain_seconds, RETAIN_SECONDS)}:
        state = _snapshot_of([c for c in commits if c.version <= version])
        keep |= set(state.after(state.base.batch_id)) | {state.base}
    return [c for c in commits if c in keep]


def gather(spark: SparkSession, path: str, kept: list[Commit]) -> None:
    """Put the records that are still needed into one file and remove the single ones."""
    folder = Folder(spark, path)
    if not kept:
        return
    newest = max(c.version for c in kept)
    old = [n for n, _, _ in folder.listed("commits") if n.endswith(".json") and int(n.split(".")[0]) <= newest]
    name = f"{newest:020d}.{new_attempt()}.json"
    folder.put_new(f"commits/{name}", "".join(_line(c) + "\n" for c in kept))
    for n in old:
        folder.remove(f"commits/{n}")
