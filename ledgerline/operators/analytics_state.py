"""The latest analytics entry of each market, kept as a versioned table.

The snapshot's history grows with every fetch; what the market job needs of it
is one entry per market. ``AnalyticsState`` keeps these in a Parquet table
bucketed and sorted by market id. A merge reads only snapshot files that no
earlier merge has read, takes their latest entries, and joins them with the
current version into the next one; of two entries the one that stands later,
by (file, position), wins, whatever order the files arrive in.

A version becomes current by its commit file, created exclusively after its
data is written: a merge that fails, or loses against one that ran beside it,
leaves the current version as it was (a loser raises; run it again). The commit
lists the files that the version covers, so a file given twice changes
nothing. Readers hold the version they opened; ``expire`` drops older ones.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.markets import ANALYTICS_ENTRY_SCHEMA, read_analytics
from .common import is_missing_path

COLUMNS = "_file string, _pos long, " + ", ".join(f"{f.name} string" for f in ANALYTICS_ENTRY_SCHEMA.fields)
BUCKETS = 64


def listed_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that a glob pattern matches, listed by Spark
    in one go: asked one by one through the driver's gateway, tens of thousands
    of files take minutes. No content is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    glob = path(pattern)
    glob = glob.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(glob)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob.getName())
    try:
        rows = reader.load(glob.getParent().toString()).select("path", "length").collect()
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return []
    # the folder itself, not what lies below it
    depth = glob.depth()
    return sorted((r.path, r.length) for r in rows if re.sub(r"^\w[\w+.-]*:(//[^/]*)?", "", r.path).count("/") == depth)


class AnalyticsState:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commit_path(self, version: int):
        return self._path(f"{self.folder}/commits/{version:010d}.json")

    def version(self) -> int:
        """Number of the current version; 0 before the first merge."""
        found = self._fs.globStatus(self._path(f"{self.folder}/commits/*.json")) or []
        return max((int(s.getPath().getName().removesuffix(".json")) for s in found), default=0)

    def commit(self, version: int) -> dict:
        """What a version covers: its data's folder and the files read."""
        if not version:
            return {"data": None, "files": {}}
        stream = self._fs.open(self._commit_path(version))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def new_files(self, pattern: str, covered: dict[str, int]) -> dict[str, int]:
        """Snapshot files (path -> bytes) that ``pattern`` matches and no merge
        has read. A file that changed its size is another snapshot: it raises."""
        out = {}
        for path, size in listed_files(self.spark, pattern):
            if path not in covered:
                out[path] = size
            elif covered[path] != size:
                raise ValueError(f"{path} changed after it was merged")
        return out

    def merge(self, pattern: str) -> int:
        """Merges the unread files that ``pattern`` matches; returns the
        version that covers them."""
        base = self.version()
        held = self.commit(base)
        files = self.new_files(pattern, held["files"])
        if not files:
            return base
        entries = read_analytics(self.spark, list(files)).select(*[c.split()[0] for c in COLUMNS.split(", ")])
        if held["data"]:
            entries = entries.unionByName(self._table(held["data"]))
        data = f"{self.folder}/data/{base + 1:010d}-{uuid.uuid4().hex}"
        self._write(latest_entries(entries), data)
        self._create(self._commit_path(base + 1), {"data": data, "files": held["files"] | files})
        return base + 1

    def entries(self) -> DataFrame:
        """The latest entry of each market, of the current version."""
        data = self.commit(self.version())["data"]
        return self._table(data) if data else self.spark.createDataFrame([], COLUMNS)

    def expire(self, keep: int = 2) -> list[int]:
        """Drops the data of all but the last ``keep`` versions."""
        gone = list(range(1, self.version() - keep + 1))
        for version in gone:
            if self._fs.exists(self._commit_path(version)):
                self._fs.delete(self._path(self.commit(version)["data"]), True)
        return gone

    def _name(self, data: str) -> str:
        return "analytics_" + data.rsplit("-", 1)[-1]

    def _write(self, rows: DataFrame, data: str) -> None:
        writer = rows.repartition(self.buckets, "market_id").write.bucketBy(self.buckets, "market_id").sortBy("market_id")
        writer.option("path", data).saveAsTable(self._name(data))

    def _table(self, data: str) -> DataFrame:
        """The table over a version's files; its buckets are in the catalog
        entry, which a later session makes again."""
        name = self._name(data)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet CLUSTERED BY (market_id) SORTED BY (market_id) INTO {self.buckets} BUCKETS LOCATION '{data}'")
        return self.spark.table(name)

    def _create(self, path, content: dict) -> None:
        try:
            stream = self._fs.create(path, False)
        except Exception as error:
            raise RuntimeError("another merge was committed meanwhile; run this one again") from error
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()


def latest_entries(entries: DataFrame) -> DataFrame:
    """One entry per market with its place; (file, position) decides."""
    data = [c for c in entries.columns if c != "market_id"]
    order = F.struct("_file", "_pos")
    best = entries.where("market_id IS NOT NULL").groupBy("market_id").agg(F.max_by(F.struct(*data), order).alias("e"))
    return best.select("e._file", "e._pos", "market_id", *[f"e.{c}" for c in data if not c.startswith("_")])
