"""Path operations through Hadoop's FileSystem, so any store Spark reads can be used."""

from __future__ import annotations

import codecs
import re
import uuid
from collections.abc import Iterator, Mapping
from functools import cached_property

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import listing as by_tasks

_GLOB_CHARACTERS = set("{}[]*?\\")


class Store:
    """Hadoop file systems as one session sees them; keep one for work on many files."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._systems: dict[str, tuple[JavaObject, str]] = {}

    def locate(self, path: str) -> tuple[JavaObject, JavaObject]:
        """The file system of ``path`` and the path itself, as Hadoop objects."""
        target, root = self._path(path), _root(path)
        if root not in self._systems:  # set in one step: threads share the store
            fs = target.getFileSystem(self._conf)
            self._systems[root] = (fs, fs.getUri().toString())
        return self._systems[root][0], target

    def uri(self, path: str) -> str:
        """``path`` as Spark's file metadata spells it."""
        return self._path(path).toUri().toString()

    def qualified(self, path: str) -> str:
        """``path`` with scheme and authority, as Spark's file metadata spells it."""
        fs, target = self.locate(path)
        return fs.makeQualified(target).toUri().toString()

    def spelled(self, path: str) -> str:
        """``path`` with scheme and authority, nothing in it encoded."""
        fs, target = self.locate(path)
        return fs.makeQualified(target).toString()

    def exists(self, path: str) -> bool:
        fs, target = self.locate(path)
        return fs.exists(target)

    def move(self, source: str, destination: str) -> bool:
        """Rename a file; ``False`` if the source is gone, which a repeated run will find.

        An existing destination is never replaced.
        """
        fs, origin = self.locate(source)
        target_fs, target = self.locate(destination)
        if target_fs.exists(target):
            if not fs.exists(origin):
                return False
            raise FileExistsError(f"{destination} is already there; {source} stays")
        try:
            near = self._systems[_root(source)][1] == self._systems[_root(destination)][1]
            moved = fs.rename(origin, target) if near else self._copy(fs, origin, target_fs, target)
        except Py4JJavaError:
            if not fs.exists(origin):
                return False
            raise
        if not moved and fs.exists(origin):
            raise OSError(f"could not move {source} to {destination}")
        return moved

    def _copy(self, fs, origin, target_fs, target) -> bool:
        return self._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, origin, target_fs, target, True, False, self._conf)

    @cached_property
    def _codecs(self) -> JavaObject:
        return self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self._conf)

    def text_lines(self, path: str, charset: str, line_sep: str | None = None, chunk: int = 1 << 14) -> Iterator[str]:
        """The lines of one file, decompressed by its extension, fetched as they are asked for.

        Bytes that the charset does not know become replacement characters, as in Spark's readers.
        """
        fs, target = self.locate(path)
        codec = self._codecs.getCodec(target)
        ends = re.compile(re.escape(line_sep)) if line_sep else re.compile(r"\r\n|\n|\r(?!\n|\Z)")
        decoder, text = codecs.getincrementaldecoder(charset)("replace"), ""
        opened = fs.open(target)
        try:
            stream = codec.createInputStream(opened) if codec else opened
            while data := bytes(stream.readNBytes(chunk)):
                text += decoder.decode(data)
                *lines, text = ends.split(text)
                yield from lines
            yield from ends.split((text + decoder.decode(b"", True)).removesuffix("\r"))
        finally:
            opened.close()


def _root(path: str) -> str:
    """Scheme and authority; empty for a path on the default file system."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return ""
    return f"{scheme}:{rest[2:].split('/', 1)[0] if rest.startswith('//') else ''}"


def handle(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of ``path`` and the path itself, as Hadoop objects."""
    return Store(spark).locate(path)


def literal(path: str) -> str:
    """``path`` with glob characters escaped, so that it names exactly one file."""
    return "".join(f"\\{c}" if c in _GLOB_CHARACTERS else c for c in path)


def unescaped(path: str) -> str:
    """What ``literal`` was made of."""
    return re.sub(r"\\(.)", r"\1", path)


def exists(spark: SparkSession, path: str) -> bool:
    return Store(spark).exists(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a directory or file this library wrote; ``False`` if it was not there."""
    fs, target = handle(spark, path)
    return fs.delete(target, True)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = handle(spark, path)
    fs.mkdirs(target)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under ``path``, hidden ones left out."""
    fs, target = handle(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def partition_values(spark: SparkSession, path: str, depth: int) -> list[dict[str, str | None]]:
    """Partition column values of the directories ``depth`` levels under ``path``."""
    if depth == 0:
        return [{}]
    fs, target = handle(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(target, "/".join(["*=*"] * depth))
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = []
    for status in fs.globStatus(pattern) or ():
        parts = status.getPath().toString().rsplit("/", depth)[1:]
        pairs = (part.split("=", 1) for part in parts)
        found.append({unescape(k): None if v == "__HIVE_DEFAULT_PARTITION__" else unescape(v) for k, v in pairs})
    return found


def partition_spec(spark: SparkSession, path: str) -> dict[str, str | None]:
    """Partition column values in a relative path such as ``a=1/b=x``."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    pairs = (part.split("=", 1) for part in path.split("/"))
    return {unescape(k): None if v in ("__HIVE_DEFAULT_PARTITION__", "null") else unescape(v) for k, v in pairs}


def listing(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """Files under ``path`` as path, length and modificationTime, those of zero bytes included; contents are not read.

    Tasks list the directories, whenever the result is evaluated. In a store that only Spark reaches the set
    of files is that of Spark's file index at this call, without files of zero bytes; those that go away before the
    result is evaluated are passed over.
    """
    fs, target = handle(spark, path)
    root = fs.makeQualified(target).toString()
    if not fs.exists(target):
        raise FileNotFoundError(path)
    if not by_tasks.reachable(root):
        return _indexed(spark, path, options)
    lower = {k.lower(): v for k, v in options.items()}
    spark.dataSource.register(by_tasks.FileListing)
    found = spark.read.format(by_tasks.FileListing.name()).option("recursiveFileLookup", lower.get("recursivefilelookup", "false")).load(root)
    if "pathglobfilter" in lower:
        found = found.where(F.substring_index("path", "/", -1).rlike(glob_pattern(lower["pathglobfilter"])))
    for name, keep in (("modifiedbefore", lambda t, limit: t < limit), ("modifiedafter", lambda t, limit: t > limit)):
        if name in lower:
            found = found.where(keep(F.col("modificationTime"), F.to_timestamp(F.lit(lower[name]))))
    return found


def glob_pattern(glob: str) -> str:
    """A Hadoop glob over a file name as a regular expression."""
    out, deep, chars = [], 0, iter(glob)
    for c in chars:
        if c == "\\":
            out.append(re.escape(next(chars, "\\")))
        elif c == "{":
            out.append("(?:")
            deep += 1
        elif c == "}" and deep:
            out.append(")")
            deep -= 1
        elif c == "[":
            inside = ""
            for d in chars:
                if d == "]":
                    break
                inside += "^" if d == "!" and not inside else d if d in "-^" else re.escape(d)
            out.append(f"[{inside}]")
        else:
            out.append({"*": ".*", "?": "."}.get(c) or ("|" if c == "," and deep else re.escape(c)))
    return f"^(?:{''.join(out)})$"


def _indexed(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    # Spark sizes scan tasks by file length, which is beside the point here: in a session of its own the
    # listing gets about one task per core, however large the files are.
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    reader = session.read.format("binaryFile").options(**options).option("ignoreMissingFiles", "true")
    return reader.load(path).select("path", "length", "modificationTime")


def scratch(spark: SparkSession, label: str) -> str:
    """A new directory in the folder the session names in ``spark.checkpoint.dir``, or has set.

    Where that is unset a local temporary folder is used if driver and executors are one process,
    as in tests; anywhere else executors would each write to their own disk, so it is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        return tempfile.mkdtemp(prefix=f"tierline-{label}-")
    return f"{shared.rstrip('/')}/tierline-{label}-{uuid.uuid4().hex}"


def has_source(spark: SparkSession, name: str) -> bool:
    """Whether a data source such as delta, kafka or avro is on the classpath."""
    try:
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(
            name, spark._jsparkSession.sessionState().conf()
        )
        return True
    except Exception:
        return False


class MissingPackage(RuntimeError):
    """A format whose Spark package is not on the classpath."""


def require_source(spark: SparkSession, name: str) -> None:
    if not has_source(spark, name):
        raise MissingPackage(f"the {name!r} data source is not on the classpath; add its Spark package to the session")
