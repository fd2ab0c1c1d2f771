"""Appends to plain Parquet tables that happen once, however often they are tried.

A commit is staged beside the table, its files are listed in a manifest, then moved into the table
under names that carry the commit's id, and marked done.  A retry goes on where the last try ended:
without a manifest it stages anew, with one it moves what is still staged, and a commit that is done
adds nothing.  Names with an underscore are not read as data.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..operators import columns as C


class Folder:
    """A folder on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def files(self, name: str = "") -> list[str]:
        if not self.has(name):
            return []
        found = [s.getPath().getName() for s in self.fs.listStatus(self._at(name)) if s.isFile()]
        return sorted(f for f in found if not f.startswith((".", "_")))

    def move(self, source: str, target: str) -> None:
        if not self.fs.rename(self._at(source), self._at(target)):
            raise OSError(f"could not move {source} to {target} in {self.path}")

    def drop(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def write(self, name: str, text: str) -> None:
        """A small file, whole or not at all."""
        self.drop(f"{name}.tmp")
        out = self.fs.create(self._at(f"{name}.tmp"))
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        self.move(f"{name}.tmp", name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def append_once(df: DataFrame, path: str, commit: str) -> int:
    """Append ``df`` to the Parquet table at ``path`` as commit ``commit``; the number of files added."""
    table = Folder(df.sparkSession, path)
    staged, manifest, done = f"_staged/{commit}", f"_commits/{commit}.files", f"_commits/{commit}.done"
    if table.has(done):
        return 0
    if not table.has(manifest):
        df.write.mode("overwrite").parquet(f"{table.path}/{staged}")
        table.write(manifest, json.dumps(table.files(staged)))
    added = 0
    for name in json.loads(table.read(manifest)):
        if table.has(f"{staged}/{name}"):
            table.move(f"{staged}/{name}", f"{commit}-{name}")
            added += 1
    table.write(done, "")
    table.drop(staged)
    return added


def commits(spark: SparkSession, path: str) -> list[str]:
    """Ids of the commits that are done, in order of their names."""
    return [f.removesuffix(".done") for f in Folder(spark, path).files("_commits") if f.endswith(".done")]


def append_classified_once(classified: DataFrame, catalog: str, history: str, commit: str) -> tuple[int, int]:
    """Rows to the catalog, by exactly its columns, and whole to the history, each once per commit.

    Both have a log of their own, so a try that ended between the two goes on with the history.
    """
    spark = classified.sparkSession
    kept = classified.persist()
    try:
        known = Folder(spark, catalog).files()
        target = spark.read.parquet(catalog).schema if known else kept.schema
        return append_once(C.align_to(kept, target), catalog, commit), append_once(kept, history, commit)
    finally:
        kept.unpersist()
