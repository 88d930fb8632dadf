"""Single files in any store that Spark reads: size, digest, copy, small writes."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

PIECE = 1 << 20


class Files:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._utils = spark._jvm.org.apache.hadoop.fs.FileUtil

    def _at(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self._conf), p

    def size(self, path: str) -> int:
        fs, p = self._at(path)
        return fs.getFileStatus(p).getLen()

    def sha256(self, path: str) -> str:
        """Digest of a file of any size, a piece at a time."""
        fs, p = self._at(path)
        source, digest = fs.open(p), hashlib.sha256()
        try:
            while piece := source.readNBytes(PIECE):
                digest.update(piece)
        finally:
            source.close()
        return digest.hexdigest()

    def write(self, path: str, text: str, overwrite: bool = True) -> None:
        fs, p = self._at(path)
        out = fs.create(p, overwrite)
        out.write(bytearray(text.encode()))
        out.close()

    def copy(self, source: str, target: str) -> None:
        fs_a, a = self._at(source)
        fs_b, b = self._at(target)
        self._utils.copy(fs_a, a, fs_b, b, False, True, self._conf)
