"""Files of a directory tree, listed and moved by tasks (M1, M5): the driver holds no file's name.

``FileListing`` is a Python data source whose partitions are directories. It reaches mounted folders and the
stores that pyarrow knows; for any other store ``storage`` goes by Spark's own file index.
"""

from __future__ import annotations

import errno
import os
import re
import shutil
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, length bigint, modificationTime timestamp"
_ARROW = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", tz="UTC"))])
_STORES = {"hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
_MOST_PARTITIONS = 512
_ROWS = 4096
_PLAIN_IN_URIS = "/:@!$&'()*+,;=~-._"


class Files:
    """Listing, looking and moving in one store, as a task can do it."""

    def __init__(self, path: str):
        scheme, colon, rest = path.partition(":")
        self.local = not colon or "/" in scheme or scheme == "file"
        self.prefix = ""
        if self.local:
            self.prefix = "file:" if scheme == "file" and colon else ""
        elif scheme in _STORES:
            from pyarrow import fs

            authority = rest.removeprefix("//").partition("/")[0]
            self.store, inner = fs.FileSystem.from_uri(f"{_STORES[scheme]}://{authority}/")
            self.prefix = f"{scheme}://{authority}"
            self.inner = inner.rstrip("/")
        else:
            raise NotImplementedError(f"no file system for {path}")

    def own(self, path: str) -> str:
        """A path as the store's own calls take it."""
        if self.local:
            return re.sub("^file:/*", "/", path) if path.startswith("file:") else path
        return self.inner + path.removeprefix(self.prefix)

    def entries(self, directory: str) -> Iterator[tuple[str, bool, int, int]]:
        """Path, whether it is a directory, length and milliseconds of what lies directly in ``directory``."""
        base = directory.rstrip("/")
        if self.local:
            with os.scandir(self.own(base) or "/") as found:
                for entry in found:
                    try:
                        status = entry.stat()
                    except FileNotFoundError:  # moved away while looked at
                        continue
                    yield f"{base}/{entry.name}", entry.is_dir(), status.st_size, status.st_mtime_ns // 1_000_000
        else:
            from pyarrow import fs

            for info in self.store.get_file_info(fs.FileSelector(self.own(base), allow_not_found=True)):
                yield f"{base}/{info.base_name}", info.type == fs.FileType.Directory, info.size or 0, (info.mtime_ns or 0) // 1_000_000

    def open(self, path: str):
        """The file for reading, at any place."""
        return open(self.own(path), "rb") if self.local else self.store.open_input_file(self.own(path))

    def write(self, path: str, data: bytes | Iterable[bytes]) -> None:
        """A whole file, complete or not there; ``data`` may come in parts, which are written as they come."""
        part = f"{os.path.dirname(path)}/.{os.path.basename(path)}.{uuid.uuid4().hex}"
        parts = [data] if isinstance(data, bytes) else data
        if self.local:
            os.makedirs(os.path.dirname(self.own(path)), exist_ok=True)
            with open(self.own(part), "wb") as file:
                file.writelines(parts)
        else:
            with self.store.open_output_stream(self.own(part)) as file:
                for some in parts:
                    file.write(some)
        self.move(part, path)

    def size(self, path: str) -> int:
        return os.path.getsize(self.own(path)) if self.local else self.store.get_file_info(self.own(path)).size

    def uri(self, path: str) -> str:
        """A path as Spark's file metadata spells it."""
        plain = f"file:{self.own(path)}" if self.local else path
        scheme, _, rest = plain.partition(":")
        return f"{scheme}:{quote(rest, safe=_PLAIN_IN_URIS)}"

    def exists(self, path: str) -> bool:
        if self.local:
            return os.path.exists(self.own(path))
        from pyarrow import fs

        return self.store.get_file_info(self.own(path)).type != fs.FileType.NotFound

    def move(self, source: str, destination: str) -> None:
        """Rename a file; FileNotFoundError if it is gone."""
        if not self.local:
            self.store.move(self.own(source), self.own(destination))
            return
        origin, target = self.own(source), self.own(destination)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        try:
            os.rename(origin, target)
        except OSError as error:
            if error.errno != errno.EXDEV:
                raise
            part = f"{target}.{uuid.uuid4().hex}"  # another disk: complete or not there
            shutil.copy2(origin, part)
            os.replace(part, target)
            os.unlink(origin)


def _hidden(name: str) -> bool:
    """Names that Spark's scans pass over."""
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _walk(files: Files, directory: str, deep: bool, everything: bool) -> Iterator[tuple[str, int, int]]:
    """Files under ``directory``; into all directories, or those that are ``name=value``."""
    waiting = [directory]
    while waiting:
        try:
            for path, is_dir, length, millis in files.entries(waiting.pop()):
                name = path.rsplit("/", 1)[1]
                if _hidden(name):
                    continue
                if not is_dir:
                    yield path, length, millis
                elif deep and (everything or "=" in name):
                    waiting.append(path)
        except FileNotFoundError:
            continue


class _Directories(InputPartition):
    def __init__(self, directories: list[str], deep: bool):
        self.directories, self.deep = directories, deep


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.everything = options.get("recursivefilelookup", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        """The top directory's own files, and the directories in it in at most 512 lots."""
        files = Files(self.path)
        inside = [
            path for path, is_dir, _, _ in files.entries(self.path)
            if is_dir and not _hidden(path.rsplit("/", 1)[1]) and (self.everything or "=" in path.rsplit("/", 1)[1])
        ]
        lots = min(_MOST_PARTITIONS, len(inside))
        return [_Directories([self.path], False), *(_Directories(inside[i::lots], True) for i in range(lots))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        files, rows = Files(self.path), []
        for directory in partition.directories:
            for path, length, millis in _walk(files, directory, partition.deep, self.everything):
                rows.append((path, length, millis * 1000))
                if len(rows) == _ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64() if i else pa.string()) for i, c in enumerate(zip(*rows))]
    return pa.RecordBatch.from_arrays([columns[0], columns[1], columns[2].cast(_ARROW.field(2).type)], schema=_ARROW)


class FileListing(DataSource):
    """``path``, ``length`` and ``modificationTime`` of files, those of zero bytes included."""

    @classmethod
    def name(cls) -> str:
        return "tierline_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def reachable(path: str) -> bool:
    """Whether tasks can list ``path`` themselves."""
    try:
        Files(path).exists(path)
        return True
    except Exception:  # no such store here, or no library for it
        return False


def touched(root: str, name: str) -> pa.RecordBatch:
    """A file without content under a local ``root``, as a task makes it; its path."""
    path = os.path.join(Files(root).own(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab"):
        pass
    return pa.RecordBatch.from_arrays([pa.array([path])], ["path"])


MOVED, GONE = "moved", "gone"


def moved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Move each file (source, archived_as, fallback), and say whether it is in its new place.

    A repeated attempt finds what the one before has moved and says the same of it. A name that is taken is never
    replaced: the file then takes its second name.
    """
    stores: dict[str, Files] = {}

    def store(path: str) -> Files:
        root = re.match(r"(?:[^:/]+:)?(?://[^/]*)?", path)[0]
        if root not in stores:
            stores[root] = Files(path)
        return stores[root]

    for batch in batches:
        outcomes = []
        for row in batch.to_pylist():
            source, *names = row.values()
            here, there = store(source), store(names[0])
            if not here.exists(source):
                outcomes.append(MOVED if any(there.exists(n) for n in names) else GONE)
                continue
            target = next((n for n in names if not there.exists(n)), None)
            if target is None:
                raise FileExistsError(f"{names[-1]} is already there; {source} stays")
            try:
                _between(here, there, source, target)
                outcomes.append(MOVED)
            except FileNotFoundError:  # another attempt was faster
                outcomes.append(MOVED if there.exists(target) else GONE)
        yield pa.RecordBatch.from_arrays([pa.array(outcomes, pa.string())], ["outcome"])


def _between(here: Files, there: Files, source: str, target: str) -> None:
    if here.local == there.local and here.prefix == there.prefix or here.local and there.local:
        here.move(source, target)
        return
    from pyarrow import fs

    origin, place = (fs.LocalFileSystem() if f.local else f.store for f in (here, there))
    fs.copy_files(here.own(source), there.own(target), source_filesystem=origin, destination_filesystem=place)
    origin.delete_file(here.own(source))
