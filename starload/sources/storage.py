"""Small files and folders beside the tables, through Hadoop's file system interface.

Tables are read and written by Spark; this module serves what is not a table: commit
records, listings of names and the removal of folders. Every path may name any file
system that Spark opens.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Stores in which a new file appears whole when it is closed, and only if there is none.
WHOLE_OBJECT_SCHEMES = frozenset({"s3", "s3a", "gs", "abfs", "abfss", "wasb", "wasbs"})


@dataclass(frozen=True)
class Entry:
    """One name in a folder; ``modified`` in milliseconds since 1970."""

    name: str
    folder: bool
    size: int
    modified: int


def _is(e: Py4JJavaError, *names: str) -> bool:
    """Whether the Java exception, or one that caused it, is of one of the classes."""
    x = e.java_exception
    while x is not None:
        if x.getClass().getSimpleName() in names:
            return True
        x = x.getCause()
    return False


class Storage:
    """File operations with the session's Hadoop settings."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def entries(self, path: str) -> list[Entry]:
        """Names in a folder in ascending order; none where it does not exist."""
        fs, p = self._at(path)
        try:
            found = fs.listStatus(p)
        except Py4JJavaError as e:
            if _is(e, "FileNotFoundException"):
                return []
            raise
        made = [Entry(f.getPath().getName(), f.isDirectory(), f.getLen(), f.getModificationTime()) for f in found]
        return sorted(made, key=lambda x: x.name)

    def files(self, path: str) -> list[Entry]:
        """Files that a path or glob names, or that lie below a folder it names; names are
        full paths. Hidden ones (``_...``, ``.``...) do not count, as in Spark's readers."""
        fs, p = self._at(path)

        def below(status) -> list[Entry]:
            if not status.isDirectory():
                return [Entry(status.getPath().toString(), False, status.getLen(), status.getModificationTime())]
            inside = [s for s in fs.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._" or "=" in s.getPath().getName()]
            return [f for s in inside for f in below(s)]

        return sorted((f for s in fs.globStatus(p) or [] for f in below(s)), key=lambda x: x.name)

    def read(self, path: str) -> str | None:
        """A small text file, or None where it does not exist."""
        fs, p = self._at(path)
        try:
            stream = fs.open(p)
        except Py4JJavaError as e:
            if _is(e, "FileNotFoundException"):
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, overwrite: bool = True) -> None:
        fs, p = self._at(path)
        out = fs.create(p, overwrite)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def delete(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.delete(p, True)

    def put_new(self, path: str, text: str) -> bool:
        """Create a file with its whole content in one step; False if there is one already.

        A reader sees the whole file or none, and a writer that dies leaves at most a
        draft that no reader looks at. Object stores create on close; elsewhere a draft
        gets its name by a step that fails where the name is taken: a hard link in local
        (and mounted) folders, a rename without overwriting in other file systems.
        """
        fs, p = self._at(path)
        folder = p.getParent()
        fs.mkdirs(folder)
        behind = fs.resolvePath(folder)  # what a mount table such as viewfs points to
        scheme = behind.toUri().getScheme()
        if scheme in WHOLE_OBJECT_SCHEMES:
            try:
                self.write(path, text, overwrite=False)
                return True
            except Py4JJavaError as e:
                if _is(e, "FileAlreadyExistsException"):
                    return False
                raise
        draft = f"{folder.toString()}/.{p.getName()}-{uuid.uuid4().hex}"
        self.write(draft, text, overwrite=False)
        try:
            if scheme == "file":
                return self._linked(draft, path)
            return self._renamed(draft, path)
        finally:
            self.delete(draft)

    def _local(self, path: str) -> str:
        fs, p = self._at(path)
        parent = fs.resolvePath(p.getParent()).toUri().getPath()
        return os.path.join(parent, p.getName())

    def _linked(self, draft: str, path: str) -> bool:
        try:
            os.link(self._local(draft), self._local(path))
        except FileExistsError:
            return False
        return True

    def _renamed(self, draft: str, path: str) -> bool:
        _, p = self._at(path)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf)
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._jvm.org.apache.hadoop.fs.Path(draft), p, options)
        except Py4JJavaError as e:
            if _is(e, "FileAlreadyExistsException"):
                return False
            raise
        return True
