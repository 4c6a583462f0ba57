"""Stored tables with a commit log: one current version, any number of writers.

A table is a folder of data folders and a folder ``log`` of numbered commits.
A commit names the data folders that make up one version, each with the
bucket of keys it holds (or none). It gets its name by a rename that never
overwrites: of two writers that want the same number, one gets it and the other reads the new version,
computes its rows again on it and tries the next number. So no writer loses
another's rows and ids drawn from the version read are not given twice. Data
folders are never changed; a reader keeps the version it began with.

An upsert into a bucketed table rewrites only the buckets that its keys fall
in; the folders of all others go on into the next version by name. A batch
that carries an id is recorded with it, and written once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

TRIES = 50


@dataclass(frozen=True)
class Version:
    """One commit: its number, the data folders as (bucket or None, folder name), and the batch ids written so far."""

    number: int
    parts: tuple[tuple[int | None, str], ...] = ()
    batches: dict[str, int] = field(default_factory=dict)


class Conflict(Exception):
    """Another writer took the number."""


class Table:
    """``schema`` rows under ``root``; with ``key`` and ``buckets``, one row per key in so many buckets of keys."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str, key: str | None = None,
                 buckets: int = 1):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.key, self.buckets = key, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- versions ----

    def current(self) -> Version:
        """The commit of the highest number; a commit is complete when it has its name."""
        log = self._path(f"{self.root}/log")
        if not self._fs.exists(log):
            return Version(0)
        names = [f.getPath().getName() for f in self._fs.listStatus(log)]
        numbers = [int(n.split(".")[0]) for n in names if n.endswith(".json")]
        return self._read(max(numbers)) if numbers else Version(0)

    def _read(self, number: int) -> Version:
        text = self.spark.read.text(f"{self.root}/log/{number:012d}.json", wholetext=True).first()[0]
        got = json.loads(text)
        return Version(number, tuple((b, f) for b, f in got["parts"]), got["batches"])

    def rows(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, the current one if none is given."""
        version = self.current() if version is None else version
        folders = [f"{self.root}/{f}" for _, f in version.parts]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _commit(self, version: Version) -> Version:
        """Give ``version`` its number, or raise ``Conflict``: the file is written aside and then named without
        overwriting, so it is whole when it is seen and a number is never taken over."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        log = f"{self.root}/log"
        self._fs.mkdirs(self._path(log))
        aside = self._path(f"{log}/{uuid.uuid4().hex}.tmp")
        name = self._path(f"{log}/{version.number:012d}.json")
        out = self._fs.create(aside, False)
        out.write(json.dumps({"parts": version.parts, "batches": version.batches}).encode())
        out.close()
        keep = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), conf).rename(aside, name, keep)
        except Py4JJavaError as error:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(version.number) from error
            raise
        return version

    # ---- writing ----

    def write(self, change: Callable[[DataFrame], DataFrame], batch: str | None = None) -> Version:
        """Append the rows that ``change`` gives for the version read; on a conflict it is asked again for the next."""
        def parts(version: Version) -> tuple:
            return (*version.parts, (None, self._data(change(self.rows(version)))))

        return self._retry(parts, batch)

    def upsert(self, new: DataFrame, batch: str | None = None) -> Version:
        """New rows win; rows whose key is not in ``new`` stay. Only the buckets of the keys of ``new`` are rewritten."""
        staged = self.spark.read.schema(self.schema).parquet(f"{self.root}/{self._data(new)}")
        touched = {r.b for r in staged.select(self._bucket().alias("b")).distinct().collect()}  # buckets at most

        def parts(version: Version) -> tuple:
            stay = tuple(p for p in version.parts if p[0] not in touched)
            old = self.rows(Version(0, tuple(p for p in version.parts if p[0] in touched)))
            both = old.join(staged.select(self.key), self.key, "left_anti").unionByName(staged)
            folder = self._data(both.withColumn("_bucket", self._bucket()), by="_bucket")
            return (*stay, *((b, f"{folder}/_bucket={b}") for b in sorted(touched)))

        return self._retry(parts, batch)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _data(self, rows: DataFrame, by: str | None = None) -> str:
        """A new data folder with ``rows``; ``by`` puts each of its values in a folder of its own."""
        folder = f"data/{uuid.uuid4().hex}"
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], *([by] if by else []))
        if by:
            rows.repartition(by).sortWithinPartitions(by, self.key).write.partitionBy(by).parquet(f"{self.root}/{folder}")
        else:
            rows.write.parquet(f"{self.root}/{folder}")
        return folder

    def _retry(self, parts: Callable[[Version], tuple], batch: str | None) -> Version:
        for _ in range(TRIES):
            version = self.current()
            if batch is not None and batch in version.batches:
                return version  # written before: by an attempt of this batch that ended after its commit
            done = version.batches | ({batch: version.number + 1} if batch is not None else {})
            try:
                return self._commit(Version(version.number + 1, parts(version), done))
            except Conflict:
                continue
        raise RuntimeError(f"{self.root}: no commit in {TRIES} tries")
