"""Whole files in any file system that Spark opens: the local disk, HDFS, object stores, by path or address."""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from quillon.session import session

#: What a file system says if it can join files without reading them.
CONCAT = "fs.capability.paths.concat"
COPY_BYTES = 1 << 20


class Files:
    """Small files are read and written whole by the driver; a reader sees all of a file or the one before it."""

    def __init__(self, spark: SparkSession | None = None):
        context = (spark or session()).sparkContext
        self._jvm, self._gateway, self._conf = context._jvm, context._gateway, context._jsc.hadoopConfiguration()

    def _path(self, path: str) -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _at(self, path: str) -> tuple[JavaObject, JavaObject]:
        """The file system of a path, and the path. Local files have no checksum files beside them, as other programs change them too."""
        p = self._path(path)
        store = p.getFileSystem(self._conf)
        return (self._jvm.org.apache.hadoop.fs.FileSystem.getLocal(self._conf).getRaw() if store.getUri().getScheme() == "file" else store), p

    def exists(self, path: str) -> bool:
        store, p = self._at(path)
        return store.exists(p)

    def is_folder(self, path: str) -> bool:
        store, p = self._at(path)
        return store.exists(p) and store.getFileStatus(p).isDirectory()

    def files(self, folder: str) -> list[str]:
        """Addresses of the files in a folder, not of its folders', by name."""
        store, p = self._at(folder)
        if not store.exists(p):
            raise FileNotFoundError(folder)
        found = [s for s in store.listStatus(p) if s.isFile()]
        return [s.getPath().toString() for s in sorted(found, key=lambda s: s.getPath().getName())]

    def size(self, path: str) -> int:
        store, p = self._at(path)
        return store.getFileStatus(p).getLen()

    def read(self, path: str) -> bytes:
        store, p = self._at(path)
        if not store.exists(p) or store.getFileStatus(p).isDirectory():
            raise FileNotFoundError(path)
        opened = store.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(opened))
        finally:
            opened.close()

    def sha256(self, paths: list[str]) -> str:
        """Of the files one after the other; their bytes stay where the files are opened."""
        whole = self._jvm.java.security.MessageDigest.getInstance("SHA-256")
        for path in paths:
            store, p = self._at(path)
            opened = self._jvm.java.security.DigestInputStream(store.open(p), whole)
            try:
                self._jvm.org.apache.commons.io.IOUtils.copyLarge(opened, self._jvm.org.apache.commons.io.output.NullOutputStream.INSTANCE)
            finally:
                opened.close()
        return bytes(whole.digest()).hex()

    def beside(self, path: str) -> str:
        """A name in the same folder that no reader takes for a file."""
        folder, _, name = path.rpartition("/")
        return f"{folder}/.{name}.{uuid.uuid4().hex}" if folder or path.startswith("/") else f".{name}.{uuid.uuid4().hex}"

    def _replace(self, source: str, target: str) -> None:
        """Another name for a file, in the place of what bore it."""
        store, p = self._at(target)
        if store.getUri().getScheme() == "file":
            if not store.rename(self._path(source), p):
                raise OSError(f"{source} can't be renamed to {target}")
            return
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), self._conf)
        context.rename(self._path(source), p, how)

    def _put(self, path: str, data: bytes) -> None:
        store, p = self._at(path)
        opened = store.create(p, True)
        try:
            opened.write(data)
        finally:
            opened.close()

    def write(self, path: str, data: bytes) -> None:
        """Through a second name, so that no reader sees half a file; folders on the way are made."""
        path = str(path)
        draft = self.beside(path)
        try:
            self._put(draft, data)
            self._replace(draft, path)
        finally:
            self.delete(draft)

    def join(self, first: bytes, parts: list[str], path: str) -> None:
        """These bytes, then the parts in their order, as one file; the parts are used up.

        File systems that can join files do so; on others the bytes are copied from stream to stream, in pieces."""
        draft = self.beside(path)
        try:
            self._put(draft, first)
            store, p = self._at(draft)
            if parts and not self._concat(store, p, parts):
                self._copy(store.create(p, True), first, parts)
            self._replace(draft, path)
        finally:
            self.delete(draft)

    def _concat(self, store: JavaObject, target: JavaObject, parts: list[str]) -> bool:
        """Whether the file system has put the parts behind the target; it may refuse, and then it has done nothing. The local
        one would begin the target anew."""
        if store.getUri().getScheme() == "file" or not store.hasPathCapability(target, CONCAT):
            return False
        listed = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, x in enumerate(parts):
            listed[i] = self._path(x)
        try:
            store.concat(target, listed)
        except Py4JJavaError:
            return False
        return True

    def _copy(self, out: JavaObject, first: bytes, parts: list[str]) -> None:
        try:
            out.write(first)
            for x in parts:
                store, p = self._at(x)
                opened = store.open(p)
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(opened, out, COPY_BYTES, False)
                finally:
                    opened.close()
        finally:
            out.close()

    def delete(self, path: str) -> None:
        """A file, or a folder with all that is in it; nothing if there is none."""
        store, p = self._at(path)
        store.delete(p, True)
