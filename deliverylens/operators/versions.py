"""Tables that are kept between runs: each version is whole or absent, and one writer wins.

A version's rows are written to a folder of their own and become the table by one
small file, its commit, put in place by a rename that never overwrites: the
protocol of Spark's own streaming checkpoints. A run that stops at any point
leaves the last version as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another run has put a version in place since this one read the table."""


class Folder:
    """A folder on any store that Spark reads, by Hadoop's own calls."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway, self.conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def store(self):
        return self.at("").getFileSystem(self.conf)

    def names(self, below: str = "") -> list[str]:
        at = self.at(below)
        return sorted(s.getPath().getName() for s in self.store().listStatus(at)) if self.store().exists(at) else []

    def delete(self, name: str) -> None:
        self.store().delete(self.at(name), True)

    def read(self, name: str) -> str:
        stream = self.store().open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """A small file that appears whole; False if there is one of that name."""
        aside = f"_{uuid.uuid4().hex}.tmp"
        out = self.store().create(self.at(aside))
        out.write(bytearray(text.encode()))
        out.close()
        parent = self.at(name).getParent()
        self.store().mkdirs(parent)
        none = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = none
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(parent.toUri(), self.conf).rename(self.at(aside), self.at(name), options)
            return True
        except Exception as error:
            self.delete(aside)
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def publish(self, aside: str, name: str) -> None:
        """Give a folder that is written its name; the name must be new."""
        parent = self.at(name).getParent()
        self.store().mkdirs(parent)
        if self.store().exists(self.at(name)) or not self.store().rename(self.at(aside), self.at(name)):
            raise Conflict(f"{name} is there already")


class VersionedTable:
    """A small keyed table, replaced as a whole at each run."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.folder, self.schema = spark, Folder(spark, path), schema

    def version(self) -> int:
        """The number of the last version, 0 if there is none."""
        commits = [int(n) for n in self.folder.names("commits") if n.isdigit()]
        return max(commits, default=0)

    def read(self, version: int | None = None) -> DataFrame:
        n = self.version() if version is None else version
        if n == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder.path}/{self.folder.read(f'commits/{n}')}")

    def replace(self, df: DataFrame, seen: int, keep: int = 2) -> int:
        """Put ``df`` in place as the version after ``seen``, the one it was worked out from.

        Raises Conflict, and changes nothing, if there is a later one by then. Of the
        versions before it ``keep`` stay, for readers that are still at them.
        """
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema.fields]
        data = f"data-{seen + 1}-{uuid.uuid4().hex}"
        df.select(*names).write.parquet(f"{self.folder.path}/{data}")
        if self.version() != seen or not self.folder.put_new(f"commits/{seen + 1}", data):
            self.folder.delete(data)
            raise Conflict(f"version {seen + 1} is there already")
        for n in self.folder.names("commits"):
            if n.isdigit() and int(n) < seen + 1 - keep:
                self.folder.delete(self.folder.read(f"commits/{n}"))
                self.folder.delete(f"commits/{n}")
        return seen + 1


class Appended:
    """A table that grows by whole passes: a pass is written aside and published by one rename."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.folder, self.schema = spark, Folder(spark, path), schema

    def read(self) -> DataFrame:
        passes = [n for n in self.folder.names() if n.startswith("pass=")]
        if not passes:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.folder.path).parquet(*[f"{self.folder.path}/{n}" for n in passes]).drop("pass")

    def append(self, df: DataFrame) -> None:
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema.fields]
        name = uuid.uuid4().hex
        try:
            df.select(*names).write.parquet(f"{self.folder.path}/_{name}")
        except BaseException:
            self.folder.delete(f"_{name}")
            raise
        self.folder.publish(f"_{name}", f"pass={name}")
