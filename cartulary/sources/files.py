"""A scan of files that accounts for each of them.

Spark's own file sources pass over files of length zero and fail a job for one file that cannot be
read. This source lists a folder, packs the files into partitions by their bytes, and gives a row for
every file: its bytes, or what kept them from being read.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, size long, content binary, problem string"
# Bytes and files of a partition; opening a file costs as much as reading so many bytes.
PARTITION_BYTES, OPEN_COST = 128_000_000, 4_000_000
# A longer file does not fit a cell of a table; it gets a problem, not a content.
CELL_BYTES = 2_000_000_000
BATCH_BYTES = 16_000_000
NOT_READ, TOO_LONG, NOT_TEXT = "cannot be read: %s", "longer than a cell of a table", "not UTF-8 text"


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


def pack(files: list[tuple[str, int]], most: int) -> list[Files]:
    """Consecutive files of about ``most`` bytes together, what opening them costs included."""
    packs: list[list[tuple[str, int]]] = []
    room = 0
    for path, size in files:
        cost = size + OPEN_COST
        if not packs or cost > room:
            packs.append([])
            room = most
        packs[-1].append((path, size))
        room -= cost
    return [Files(p) for p in packs]


class FileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.glob = options["path"], options.get("glob", "*")
        self.content = options.get("content", "true") == "true"
        self.most = int(options.get("partitionbytes", PARTITION_BYTES))
        self.cell = int(options.get("cellbytes", CELL_BYTES))

    def partitions(self) -> list[Files]:
        store, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        top = store.get_file_info(root)
        if top.type == pyarrow.fs.FileType.NotFound:
            raise FileNotFoundError(self.folder)
        found = [top] if top.is_file else store.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        hidden = lambda path: any(p[:1] in ("_", ".") for p in path[len(root) :].split("/"))
        files = [(f.path, f.size) for f in found if f.is_file and fnmatch.fnmatchcase(f.base_name, self.glob) and not hidden(f.path)]
        return pack(sorted(files), self.most) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        prefix = self.folder[: -len(root)] if self.folder.endswith(root) else ""
        prefix = prefix.removesuffix("//") or "file:"
        rows: list[tuple] = []
        held = 0
        for path, size in partition.files:
            content, problem = None, None
            if size > self.cell:
                problem = TOO_LONG
            elif self.content:
                try:
                    with store.open_input_stream(path) as stream:
                        content = stream.read()
                except OSError as reason:
                    problem = NOT_READ % reason
            rows.append((prefix + path, size, content, problem))
            held += len(content or b"")
            if held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "size", "content", "problem"])


class FileSource(DataSource):
    """``path, size, content, problem`` of every file below a folder, hidden ones left out.

    Options: ``path`` (a folder or a file), ``glob`` (of file names), ``content`` (``false`` lists
    only), ``partitionBytes``, ``cellBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "accounted_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> FileReader:
        return FileReader(self.options)


def _known(folder: str) -> bool:
    try:
        pyarrow.fs.FileSystem.from_uri(folder)
    except (pa.ArrowInvalid, OSError):
        return False
    return True


def read_files(spark: SparkSession, folder: str, glob: str = "*", content: bool = True, **options: str) -> DataFrame:
    """``path, size, content, problem`` of every file, a row each.

    A store that only Spark's readers know is read by them; what they pass over, files of length zero, is
    added from the names they list.
    """
    if _known(folder):
        spark.dataSource.register(FileSource)
        reader = spark.read.format(FileSource.name()).options(path=folder, glob=glob, content=str(content).lower(), **options)
        return reader.load()
    return spark_files(spark, folder, glob, content)


def spark_files(spark: SparkSession, folder: str, glob: str = "*", content: bool = True) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    read = files.select("path", F.col("length").alias("size"), (F.col("content") if content else F.lit(None).cast("binary")).alias("content"))
    listed = [(re.sub("^([a-z0-9]+):///", r"\1:/", unquote(name)),) for name in files.inputFiles()]
    names = spark.createDataFrame(listed, "path string").repartition("path")
    void = names.join(files.select("path"), "path", "left_anti").select("path", F.lit(0).cast("long").alias("size"), F.lit(b"").alias("content"))
    return read.unionByName(void).withColumn("problem", F.lit(None).cast("string"))


def text_of(content: str = "content") -> Column:
    """The text of a file; null if it has no bytes or is not UTF-8."""
    text = F.col(content).cast("string")
    return F.when((F.octet_length(F.col(content)) > 0) & F.is_valid_utf8(text), text)


def problem_of(content: str = "content", problem: str = "problem") -> Column:
    """Why a file has no text, if there is a reason but its being empty."""
    text = F.col(content).cast("string")
    return F.coalesce(F.col(problem), F.when(~F.is_valid_utf8(text), F.lit(NOT_TEXT)))
