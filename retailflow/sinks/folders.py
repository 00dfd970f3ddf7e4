"""Folder swaps through the file system of the session.

New files are written whole into a staging folder first; only then do folders change
places, by renames. A write that fails leaves the old files as they were.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Renames under way at once.
MOVES = 16


class Folders:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename a folder to a path that does not exist yet."""
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._path(source), to):
            raise OSError(f"cannot move {source} to {target}")

    def names(self, path: str) -> list[str]:
        """Names of what a folder holds; none if there is no such folder."""
        place = self._path(path)
        if not self._fs.exists(place):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(place))

    def add(self, source: str, target: str) -> None:
        """Put the files of the partition folders right below ``source`` beside those of ``target``."""
        parts = [n for n in self.names(source) if n[0] not in "._"]
        pairs = [(f"{source}/{p}/{f}", f"{target}/{p}/{f}") for p in parts for f in self.names(f"{source}/{p}")]
        with ThreadPoolExecutor(max_workers=MOVES) as pool:
            list(pool.map(lambda pair: self.move(*pair), pairs))

    def leaves(self, root: str, below: str = "") -> list[str]:
        """Partition folders ``a=1/b=2`` below ``root`` that hold files."""
        found, files = [], False
        for status in self._fs.listStatus(self._path(f"{root}/{below}" if below else root)):
            name = status.getPath().getName()
            if name[0] in "._":
                continue
            if status.isDirectory():
                found += self.leaves(root, f"{below}/{name}" if below else name)
            else:
                files = True
        return [*found, below] if files and below else found


def fresh(path: str, what: str) -> str:
    """An unused folder below ``path`` that readers ignore."""
    return f"{path}/_{what}-{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged table in the place of the one at ``path``."""
    folders = Folders(spark, path)
    aside = f"{path}_replaced-{uuid.uuid4().hex}"
    old = folders.exists(path)
    if old:
        folders.move(path, aside)
    try:
        folders.move(staged, path)
    except Exception:
        if old:
            folders.move(aside, path)
        raise
    if old:
        folders.delete(aside)
    spark.catalog.refreshByPath(path)


def replace_partitions(spark: SparkSession, staged: str, path: str, old: list[str]) -> None:
    """Put all staged partitions in the place of the ``old`` ones of the table at ``path``.

    Partitions that are old and not staged are gone afterwards. A move that fails puts
    everything back. The swap of many partitions is not one step for readers.
    """
    folders = Folders(spark, path)
    aside = fresh(path, "replaced")
    moved: list[tuple[str, str]] = []

    def move(pair: tuple[str, str]) -> None:
        folders.move(*pair)
        moved.append(pair)

    try:
        with ThreadPoolExecutor(max_workers=MOVES) as pool:
            list(pool.map(move, [(f"{path}/{part}", f"{aside}/{part}") for part in old]))
            list(pool.map(move, [(f"{staged}/{part}", f"{path}/{part}") for part in folders.leaves(staged)]))
    except Exception:
        for origin, place in reversed(moved):
            folders.move(place, origin)
        raise
    for folder in (aside, staged):
        folders.delete(folder)
    spark.catalog.refreshByPath(path)
