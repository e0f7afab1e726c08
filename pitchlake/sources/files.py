"""File operations on whatever file system a path names."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


class Files:
    """File operations on whatever file system a path names."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    @staticmethod
    def decoded(uri: str) -> str:
        """The path that a file's URI stands for (Spark shows files as URIs, in which % itself is escaped)."""
        return unquote(uri)

    def qualified(self, path: str) -> str:
        fs, p = self._at(path)
        return str(fs.makeQualified(p).toString())

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def is_file(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isFile())

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def rename(self, old: str, new: str) -> None:
        fs, p = self._at(old)
        to = self._at(new)[1]
        fs.mkdirs(to.getParent())
        if not fs.rename(p, to):
            raise OSError(f"can't rename {old} to {new}")

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing if it isn't there."""
        fs, p = self._at(path)
        return sorted(str(f.getPath().toString()) for f in fs.listStatus(p)) if fs.exists(p) else []

    def write_text(self, path: str, text: str) -> None:
        """A small file, made anew."""
        fs, p = self._at(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
