"""The files below a folder with their SHA-256, as a data source.

``binaryFile`` hands over whole contents, so it has no files of length 0 and none
of over 2 GiB. Here a task lists its folders and hashes its files in pieces, so
all files count and none has to fit into memory.
"""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import batched

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PIECE = 8 << 20


@dataclass
class _Part(InputPartition):
    """Folders to list to their ends, and files."""

    folders: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)


class _Reader(DataSourceReader):
    def __init__(self, root: str, splits: int, files_per_split: int):
        self.root, self.splits, self.files_per_split = root, splits, files_per_split

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root if ":/" in self.root else f"file://{self.root}")

    def partitions(self) -> list[_Part]:
        """Folders are opened level by level until there are enough of them to share out."""
        store, base = self._open()
        folders, files = [base], []
        while folders and len(folders) < self.splits:
            below = [entry for folder in folders for entry in store.get_file_info(fs.FileSelector(folder))]
            files += [e.path for e in below if e.type == fs.FileType.File]
            folders = [e.path for e in below if e.type == fs.FileType.Directory]
        return [_Part(folders=[f]) for f in folders] + [_Part(files=list(some)) for some in batched(files, self.files_per_split)] or [_Part()]

    def read(self, partition: _Part) -> Iterator[tuple[str, int, str]]:
        store, base = self._open()
        listed = (e.path for folder in partition.folders for e in store.get_file_info(fs.FileSelector(folder, recursive=True)) if e.type == fs.FileType.File)
        for path in [*partition.files, *listed]:
            digest, size = hashlib.sha256(), 0
            with store.open_input_stream(path) as file:
                while piece := file.read(PIECE):
                    digest.update(piece)
                    size += len(piece)
            yield posixpath.relpath(path, base), size, digest.hexdigest()


class FolderHashes(DataSource):
    """Options: ``path``, ``splits`` (folders to share out), ``files_per_split``."""

    @classmethod
    def name(cls) -> str:
        return "folder_hashes"

    def schema(self) -> str:
        return "path STRING, n_bytes BIGINT, content_hash STRING"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("splits", 64)), int(self.options.get("files_per_split", 1000)))


def folder_hashes(spark: SparkSession, folder: str, splits: int = 64, files_per_split: int = 1000) -> DataFrame:
    """(path relative to the folder, n_bytes, content_hash) of every file below it."""
    spark.dataSource.register(FolderHashes)
    return spark.read.format("folder_hashes").options(splits=splits, files_per_split=files_per_split).load(folder)
