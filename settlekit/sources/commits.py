"""Numbered commits: small documents of a dataset's state, each of which appears whole or not at all.

A dataset writes new folders first and then commits a document that names the folders
that count. Readers follow the newest document, so a write that dies midway leaves
what was there; folders that no kept document names are dropped after a commit.
A document is written beside its place and renamed to it without replacing, so of two
writers with the same number one fails (``CommitConflict``) and starts from the newer
state. The store's rename must not replace (HDFS, local disk; object stores need a
committer that gives this).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer took this commit's number."""


class CommitLog:
    """Commits ``<folder>/<number>.json``; a document holds the dataset's whole state."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, name: str = ""):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def numbers(self) -> list[int]:
        fs, path = self._fs()
        if not fs.exists(path):
            return []
        found = (re.fullmatch(r"(\d+)\.json", status.getPath().getName()) for status in fs.listStatus(path))
        return sorted(int(m[1]) for m in found if m)

    def read(self, number: int) -> dict:
        fs, path = self._fs(f"{number:010d}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """Number and document of the newest commit; 0 and an empty one before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, after: int, document: dict) -> int:
        """Commit ``document`` as the one after ``after``; ``CommitConflict`` if that number is taken."""
        number, jvm = after + 1, self.spark._jvm
        fs, target = self._fs(f"{number:010d}.json")
        _, beside = self._fs(f".{number:010d}-{uuid.uuid4().hex[:8]}.tmp")
        fs.mkdirs(target.getParent())
        out = fs.create(beside, False)
        out.write(bytearray(json.dumps(document, sort_keys=True).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(beside), fs.makeQualified(target), plain)
        except Exception as e:
            fs.delete(beside, False)
            if fs.exists(target):
                raise CommitConflict(f"commit {number} of {self.folder} is there already") from e
            raise
        return number

    def change(self, edit: Callable[[dict], None], attempts: int = 20) -> tuple[int, dict]:
        """Commit the newest document as ``edit`` changes it, starting anew where another writer was first."""
        for _ in range(attempts):
            number, document = self.latest()
            edit(document)
            try:
                return self.commit(number, document), document
            except CommitConflict:
                continue
        raise CommitConflict(f"{attempts} writers in a row were first at {self.folder}")

    def kept(self, n: int = 2) -> list[dict]:
        """The ``n`` newest documents; older ones are dropped."""
        numbers = self.numbers()
        fs, _ = self._fs()
        for number in numbers[:-n]:
            fs.delete(self._fs(f"{number:010d}.json")[1], False)
        return [self.read(number) for number in numbers[-n:]]


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path`` (none, if it isn't there)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
