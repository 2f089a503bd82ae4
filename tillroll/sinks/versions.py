"""Committed versions of a table: data goes into a folder of its own, and the version exists
once its manifest does, which is written last and appears in one step. Readers list the
manifests, so what a killed job left behind is never chosen and never seen, and a refresh
never changes files that someone is reading."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sinks.files import write_csv
from tillroll.sources.snapshots import read_csv

FORMATS = ("parquet", "csv")
_DATA, _LOG = "data", "committed"


@dataclass(frozen=True)
class Version:
    """What a manifest says. ``files`` and ``size`` are those of the folder when it was
    committed: a version that has lost a file since is not read as if it were whole."""

    number: int
    path: str
    fmt: str
    schema: str
    rows: int
    files: int
    size: int


class _Files:
    """The few file system calls needed, through the session's own Hadoop configuration."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._system = self.path(path).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        if not self._system.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self._system.listStatus(self.path(folder))]

    def summary(self, folder: str) -> tuple[int, int]:
        """Number and bytes of the data files of a folder."""
        found = self._system.listStatus(self.path(folder))
        sizes = [s.getLen() for s in found if not s.getPath().getName().startswith((".", "_"))]
        return len(sizes), sum(sizes)

    def read(self, name: str) -> str:
        stream = self._system.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """The file with its whole text, or False where there is one already."""
        target, part = self.path(name), self.path(f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
        stream = self._system.create(part, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        kinds = self._gateway.new_array(options, 1)
        kinds[0] = options.NONE  # never replaces a file
        context = self._jvm.org.apache.hadoop.fs.FileContext
        try:
            context.getFileContext(target.toUri(), self._conf).rename(
                self._system.makeQualified(part), self._system.makeQualified(target), kinds
            )
        except Exception as error:
            self._system.delete(part, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._system.delete(self.path(name), True)


def versions(spark: SparkSession, base: str) -> list[Version]:
    """The committed versions, oldest first."""
    files = _Files(spark, base)
    names = [n for n in files.names(f"{base}/{_LOG}") if n.endswith(".json") and n[0] != "."]
    found = (json.loads(files.read(f"{base}/{_LOG}/{name}")) for name in sorted(names))
    return [Version(**entry) for entry in found]


def stage(df: DataFrame, base: str, fmt: str = "parquet") -> Version:
    """Write the data of a version that nobody sees yet; its number is still 0."""
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt} is none of {FORMATS}")
    spark, path = df.sparkSession, f"{base}/{_DATA}/{uuid.uuid4().hex}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if fmt == "csv":
        write_csv(counted, path)
    else:
        counted.write.parquet(path)
    number, size = _Files(spark, base).summary(path)
    return Version(0, path, fmt, df.schema.json(), seen.get["rows"], number, size)


def commit(spark: SparkSession, base: str, staged: Version) -> Version:
    """Make a staged version the newest. Of two writers that commit at the same time both
    succeed, one after the other: the number is taken by whoever creates its manifest."""
    files = _Files(spark, base)
    while True:
        taken = [v.number for v in versions(spark, base)]
        version = Version(**{**asdict(staged), "number": max(taken, default=0) + 1})
        if files.create(f"{base}/{_LOG}/{version.number:012d}.json", json.dumps(asdict(version))):
            return version


def write_version(df: DataFrame, base: str, fmt: str = "parquet") -> Version:
    return commit(df.sparkSession, base, stage(df, base, fmt))


def read_version(spark: SparkSession, base: str, number: int | None = None) -> DataFrame:
    """The newest committed version, or an older one by its number. None at all raises, and
    so does one whose files are not those that were committed."""
    known = {v.number: v for v in versions(spark, base)}
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"no version {'' if number is None else number} in {base}")
    version = known[max(known) if number is None else number]
    there = _Files(spark, base).summary(version.path)
    if there != (version.files, version.size):
        raise OSError(f"version {version.number} of {base} has {there} files and bytes, not "
                      f"{(version.files, version.size)}")
    schema = T.StructType.fromJson(json.loads(version.schema))
    if version.fmt == "csv":
        return read_csv(spark, version.path, schema)
    return spark.read.schema(schema).parquet(version.path)


def publish(df: DataFrame, base: str, view: str) -> DataFrame:
    """Full refresh of a named relation: a new version, then one change of the catalog view
    that names it. A reader has the old rows or the new ones, whole; a second run with the
    same rows changes nothing but the version."""
    spark = df.sparkSession
    version = write_version(df, base)
    columns = ", ".join(f"`{c.replace('`', '``')}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{version.path}`")
    return spark.table(view)


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[Version]:
    """Drop all but the newest ``keep`` versions, manifests first, and the data of no version;
    run it when no job writes. Returns what is left."""
    if keep < 1:
        raise ValueError("the newest version stays")
    files, known = _Files(spark, base), versions(spark, base)
    for version in known[:-keep]:
        files.delete(f"{base}/{_LOG}/{version.number:012d}.json")
    left = known[-keep:]
    live = {v.path.rsplit("/", 1)[-1] for v in left}
    for name in files.names(f"{base}/{_DATA}"):
        if name not in live:
            files.delete(f"{base}/{_DATA}/{name}")
    return left
