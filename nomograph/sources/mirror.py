"""A local mirror that follows a feed of changes.

Rows lie in buckets by the hash of their key. A merge writes the buckets that the feed touches into a folder of its own
and then, by renaming one small file, a mark that says which folder holds each bucket and up to which change they go. Until then the
mirror is as it was: a merge that dies leaves a folder that nothing names, and may simply be run again. Deleted rows stay
as tombstones, so that an older change that comes again doesn't bring them back.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16


class Mirror:
    """A table of key, seq, deleted and other columns; of each key the change of the greatest seq."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        """schema: the other columns."""
        self.spark, self.folder = spark, folder
        self.columns = [c.name for c in spark.createDataFrame([], schema).schema]
        self.schema = f"key string, seq long, deleted boolean, {schema}"

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def mark(self) -> dict:
        """seq: changes up to it are in; buckets: the folder of each bucket that has rows."""
        files, path = self._path("mark.json")
        if not files.exists(path):
            return {"seq": -1, "buckets": {}}
        return json.loads(self.spark.read.text(f"{self.folder}/mark.json", wholetext=True).first()[0])

    def _set_mark(self, mark: dict) -> None:
        files, to = self._path("mark.json")
        _, fresh = self._path(f"mark-{uuid.uuid4().hex}.json")
        out = files.create(fresh, True)
        out.write(bytearray(json.dumps(mark).encode()))
        out.close()
        jvm, options = self.spark._jvm, self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        over = self.spark.sparkContext._gateway.new_array(options, 1)
        over[0] = options.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(to).toUri(), self.spark._jsc.hadoopConfiguration()).rename(files.makeQualified(fresh), files.makeQualified(to), over)

    def _read(self, buckets: dict[str, str]) -> DataFrame:
        paths = [f"{self.folder}/{of}/bucket={k}" for k, of in buckets.items()]
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        return rows.select("key", "seq", "deleted", *self.columns)

    def rows(self, tombstones: bool = False) -> DataFrame:
        rows = self._read(self.mark()["buckets"])
        return rows if tombstones else rows.where("NOT deleted").drop("deleted")

    def merge(self, feed: DataFrame) -> dict:
        """feed: key, seq (each change's own, rising), deleted, and the other columns. Applies what the mirror doesn't have yet; returns the new mark. Changes without a key are left out; of equal seq one of a key's counts, the same in each run."""
        mark = self.mark()
        # of each key only the last change travels
        bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")
        last = feed.where(F.col("key").isNotNull() & (F.col("seq") > mark["seq"])).select("key", "seq", "deleted", *self.columns)
        last = last.groupBy("key").agg(F.max(F.struct("seq", "deleted", *self.columns)).alias("c")).select("key", "c.*").withColumn("bucket", bucket)
        stage = f"merge-{uuid.uuid4().hex}"
        last.write.parquet(f"{self.folder}/{stage}/feed")
        last = self.spark.read.parquet(f"{self.folder}/{stage}/feed")
        top, touched = last.agg(F.max("seq"), F.collect_set("bucket")).first()  # BUCKETS at most
        if top is None:
            return mark
        old = self._read({k: of for k, of in mark["buckets"].items() if int(k) in touched}).withColumn("bucket", bucket)
        new = old.unionByName(last).groupBy("bucket", "key").agg(F.max(F.struct("seq", "deleted", *self.columns)).alias("c")).select("bucket", "key", "c.*")
        new.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{stage}/rows")
        now = {"seq": top, "buckets": mark["buckets"] | {str(b): f"{stage}/rows" for b in touched}}
        self._set_mark(now)
        return now

    def sweep(self) -> int:
        """Removes folders that the mark doesn't name: those of dead merges, and buckets that later merges have replaced wholly. Only while no merge runs. Returns how many."""
        used = {of.split("/")[0] for of in self.mark()["buckets"].values()}
        files, top = self._path("")
        gone = [s.getPath() for s in files.listStatus(top) if s.getPath().getName().startswith("merge-") and s.getPath().getName() not in used]
        for path in gone:
            files.delete(path, True)
        return len(gone)
