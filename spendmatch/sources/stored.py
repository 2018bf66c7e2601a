"""Stored sync targets: Parquet in hash buckets of the key, committed by version files.

A table is a folder of *parts*.  A part is one write, in buckets of the key's
hash; a version file names, for each bucket, the part that holds it.  A change
rewrites the buckets it touches into a new part and commits the next version
file, so readers see the old version or the new one, and a job that dies before
its commit leaves nothing but files that no version names.

Reads go through Spark's bucketed scan, so joins and groupings on the key need
no exchange.  The session table behind it is dropped at once; files stay.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
BUCKET_FILE = re.compile(r"_(\d{5})\.c\d+")   # Spark's name of a bucketed file
_SESSION_TABLES = threading.Lock()


class CommitConflict(RuntimeError):
    """Another job committed this version first."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    keys: list[str]
    buckets: int
    live: dict[str, list[int]]                 # part -> buckets it holds
    info: dict = field(default_factory=dict)   # what the commit says about itself


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket Spark's bucketed writer puts a row in."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def bucketed_scan(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int) -> tuple[DataFrame, str]:
    """(table, name): the parts under ``path`` as a bucketed table with the column ``_part``; the caller drops the name."""
    name = f"stored_{uuid.uuid4().hex}"
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    tracked = "spark.sql.hive.manageFilesourcePartitions"
    with _SESSION_TABLES:  # parts are found by listing the folder, not in the catalog
        old = spark.conf.get(tracked)
        spark.conf.set(tracked, "false")
        try:
            spark.sql(f"CREATE TABLE {name} ({cols}, {PART} string) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY ({PART}) "
                      f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
        finally:
            spark.conf.set(tracked, old)
    return spark.table(name), name


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """The parts under ``path`` as a DataFrame whose scans are bucketed."""
    df, name = bucketed_scan(spark, path, schema, keys, buckets)
    spark.sql(f"DROP TABLE {name}")
    return df


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` (with a column ``_part``) under ``path``; return the bucketed scan of it.

    Rows are dealt by key first unless they are already, so each task writes
    one file per part.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name != PART])
    _, name = bucketed_scan(df.sparkSession, path, schema, keys, buckets)
    df.select(*schema.fieldNames(), PART).write.insertInto(name)
    df.sparkSession.sql(f"DROP TABLE {name}")
    return read_bucketed(df.sparkSession, path, schema, keys, buckets)


class StoredTable:
    """One stored target under ``path``.  Key columns must not be NULL."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark._jvm

    # ------------------------------------------------------------ file system
    def _at(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _fs(self):
        return self._at().getFileSystem(self._conf())

    def _list(self, *parts: str) -> list[str]:
        fs, at = self._fs(), self._at(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    # --------------------------------------------------------------- versions
    def versions(self) -> list[int]:
        return [int(n[:8]) for n in self._list("_versions") if re.fullmatch(r"\d{8}\.json", n)]

    def version(self, number: int) -> Version:
        stream = self._fs().open(self._at("_versions", f"{number:08d}.json"))
        try:
            d = json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(d["number"], T.StructType.fromJson(d["schema"]), d["keys"], d["buckets"], d["live"], d["info"])

    def latest(self) -> Version | None:
        n = self.versions()
        return self.version(n[-1]) if n else None

    def commit(self, version: Version) -> Version:
        """Publish ``version`` unless its number is taken, which raises :class:`CommitConflict`.

        The file is written aside and renamed without overwriting, which is
        one step on HDFS; stores without such a rename need a lock of their own.
        """
        text = json.dumps({"number": version.number, "schema": version.schema.jsonValue(), "keys": version.keys,
                           "buckets": version.buckets, "live": version.live, "info": version.info})
        fs, aside = self._fs(), self._at("_versions", f".{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri() if aside.toUri().getScheme() else fs.getUri(), self._conf())
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(self._at("_versions", f"{version.number:08d}.json")), options)
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise CommitConflict(f"{self.path}: version {version.number} exists") from e
            raise
        return version

    def next(self, base: Version, part: str | None, buckets: list[int], **info) -> Version:
        """Commit a version in which ``part`` holds ``buckets`` and every other bucket stays where it is."""
        gone = set(buckets)
        live = {p: kept for p, bs in base.live.items() if (kept := [b for b in bs if b not in gone])}
        if part is not None and buckets:
            live[part] = sorted(buckets)
        return self.commit(Version(base.number + 1, base.schema, base.keys, base.buckets, live, info))

    # ------------------------------------------------------------------- data
    def new_part(self, df: DataFrame, version: Version) -> str:
        """Write the rows of some whole buckets as a part that no version names yet."""
        part = f"{version.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in version.schema.fields], F.lit(part).alias(PART))
        write_bucketed(typed, f"{self.path}/parts", version.keys, version.buckets)
        return part

    def files(self, version: Version, buckets: list[int]) -> list[str]:
        """The files that hold ``buckets``, at most one per bucket and writing task."""
        out = []
        for part, held in version.live.items():
            wanted = set(held) & set(buckets)
            folder = f"parts/{PART}={part}"
            out += [f"{self.path}/{folder}/{n}" for n in self._list(folder)
                    if (m := BUCKET_FILE.search(n)) and n.endswith(".parquet") and not n.startswith(".") and int(m[1]) in wanted]
        return out

    def read(self, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version (the latest), or of some of its buckets.

        The whole table, or most of it, is a bucketed scan.  Up to half of the
        buckets are read from their own files, dealt by key into as many
        partitions as the table has buckets.
        """
        v = version or self.latest()
        if v is None:
            raise FileNotFoundError(f"{self.path} has no version")
        if not v.live:
            return self.spark.createDataFrame([], v.schema)
        if buckets is not None and 2 * len(buckets) <= v.buckets:
            files = self.files(v, buckets)
            rows = self.spark.read.schema(v.schema).parquet(*files) if files else self.spark.createDataFrame([], v.schema)
            return rows.repartition(v.buckets, *v.keys)
        held = F.lit(False)
        for part, live in v.live.items():
            own = F.col(PART) == part
            wanted = live if buckets is None else [b for b in live if b in set(buckets)]
            if wanted:
                held = held | (own if len(wanted) == v.buckets else own & bucket_of(v.keys, v.buckets).isin(wanted))
        rows = read_bucketed(self.spark, f"{self.path}/parts", v.schema, v.keys, v.buckets)
        return rows.where(held).drop(PART)

    def vacuum(self, keep: int = 2) -> int:
        """Delete files that none of the last ``keep`` versions names, and older versions; returns the number of files.

        Parts of jobs that are still writing go too, so run it when none is.
        """
        numbers = self.versions()
        kept = [self.version(n) for n in numbers[-keep:]]
        fs, n = self._fs(), 0
        for folder in self._list("parts"):
            part = folder.removeprefix(f"{PART}=")
            live = {b for v in kept for b in v.live.get(part, [])}
            for name in self._list(f"parts/{folder}") if folder.startswith(PART) else []:
                m = BUCKET_FILE.search(name)
                if m and int(m[1]) not in live:
                    n += bool(fs.delete(self._at("parts", folder, name), False)) and name.endswith(".parquet") and not name.startswith(".")
        for old in numbers[:-keep]:
            fs.delete(self._at("_versions", f"{old:08d}.json"), False)
        return n


def ensure_stored(store: StoredTable, schema: T.StructType, keys: list[str], buckets: int = 64, **info) -> tuple[Version, bool]:
    """S6 for a stored target: (version, created).  An existing table stays as it is.

    Of two jobs that create it at once one wins; the other uses the winner's.
    """
    now = store.latest()
    if now is not None:
        return now, False
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    try:
        return store.commit(Version(1, plain, list(keys), buckets, {}, info)), True
    except CommitConflict:
        return store.latest(), False


def load_stored(store: StoredTable, df: DataFrame, keys: list[str], buckets: int = 64, **info) -> bool:
    """The first load, refused (False) when the table holds rows or another load commits first.

    The version that was seen empty is the one the commit follows, so two loads
    that both saw an empty table cannot both pass.
    """
    base, _ = ensure_stored(store, df.schema, keys, buckets)
    if base.live:
        return False
    part = store.new_part(df.repartition(base.buckets, *base.keys), base)
    try:
        store.next(base, part, list(range(base.buckets)), **info)
    except CommitConflict:
        return False
    return True
