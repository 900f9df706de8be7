"""A store of runs: staged writes, one published marker per run, readers of whole runs only.

Layout under ``root``::

    data/run=<run>/attempt=<id>/...parquet    every attempt writes a folder of its own
    commits/<run>/<sequence>-<id>             a marker, made when the write has ended

A run is what its newest marker names. Writing a run again (a retry, a
correction) replaces it as a whole: rows that the new attempt lacks are gone
with the old attempt. A job that dies before its marker leaves a folder that no
reader looks at, and readers that started earlier keep the attempt they listed.
A marker counts once it has content, so no lock and no rename is needed, on
object stores either. ``vacuum`` removes what no marker names.

Markers are listed by Spark (``binaryFile``, content pruned) and joined to the
data by run and attempt, which Catalyst turns into partition pruning; neither
rows nor the list of runs passes through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_feeds import plain_path

RUN, ATTEMPT = "run", "attempt"


class RunStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jvm(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def stage(self, rows: DataFrame, run: str, partition_by: Sequence[str] = ()) -> str:
        """Write an attempt of a run, unseen by readers; returns its id."""
        if {RUN, ATTEMPT} & set(rows.columns):
            raise ValueError(f"{RUN} and {ATTEMPT} name the store's own columns")
        attempt = f"a{uuid.uuid4().hex}"  # never read as a number
        w = rows.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/data/{RUN}={_folder(run)}/{ATTEMPT}={attempt}")
        return attempt

    def publish(self, run: str, attempt: str) -> None:
        """Make an attempt the run's content, whatever was published before."""
        folder = f"{self.root}/commits/{_folder(run)}"
        self._fs.mkdirs(self._jvm(folder))
        last = max((int(s.getPath().getName().split("-")[0]) for s in self._fs.listStatus(self._jvm(folder))), default=0)
        out = self._fs.create(self._jvm(f"{folder}/{last + 1:012d}-{attempt}"), False)  # fails where the marker exists
        out.write(bytearray(attempt.encode()))
        out.close()

    def write(self, rows: DataFrame, run: str, partition_by: Sequence[str] = ()) -> None:
        """Stage and publish: the run is replaced as a whole."""
        self.publish(run, self.stage(rows, run, partition_by))

    def runs(self) -> DataFrame:
        """(run, attempt, published_at) of every published run."""
        none = T.StructType([T.StructField(RUN, T.StringType()), T.StructField(ATTEMPT, T.StringType()), T.StructField("published_at", T.TimestampType())])
        if not self._fs.globStatus(self._jvm(f"{self.root}/commits/*/*")):
            return self.spark.createDataFrame([], none)
        path = plain_path(F.col("path"))
        marker = F.element_at(F.split(path, "/"), -1)
        listed = (self.spark.read.format("binaryFile").load(f"{self.root}/commits/*/*")
                  .select(_run(F.element_at(F.split(path, "/"), -2)).alias(RUN), marker.alias("marker"), F.col("modificationTime").alias("published_at")))
        newest = listed.groupBy(RUN).agg(F.max(F.struct("marker", "published_at")).alias("m"))
        return newest.select(RUN, F.substring_index("m.marker", "-", -1).alias(ATTEMPT), "m.published_at")

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """Rows of all published runs with ``run``; attempts that were replaced or never published are not read.

        ``schema``: of the stored rows, needed while nothing is published.
        """
        if not self._fs.globStatus(self._jvm(f"{self.root}/commits/*/*")):
            if schema is None:
                raise FileNotFoundError(f"nothing is published under {self.root}")
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(RUN, T.StringType())]))
        reader = self.spark.read.option("basePath", f"{self.root}/data").option("mergeSchema", schema is None)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(ATTEMPT, T.StringType())]))
        data = reader.parquet(f"{self.root}/data")
        # attempts are unique, so they alone prune the folders
        return data.join(self.runs().select(ATTEMPT), ATTEMPT, "left_semi").withColumn(RUN, _run(F.col(RUN))).drop(ATTEMPT)

    def vacuum(self) -> int:
        """Remove attempts that no newest marker names, and older markers; returns how many attempts went.

        For a quiet store: a write that is still staging is not published, either.
        """
        live = {(r[RUN], r[ATTEMPT]) for r in self.runs().select(RUN, ATTEMPT).toLocalIterator()}
        gone = 0
        for st in self._fs.globStatus(self._jvm(f"{self.root}/data/{RUN}=*/{ATTEMPT}=*")) or []:
            run, attempt = (p.getName().split("=", 1)[1] for p in (st.getPath().getParent(), st.getPath()))
            if (_name(run), attempt) not in live:
                self._fs.delete(st.getPath(), True)
                gone += 1
        for st in self._fs.globStatus(self._jvm(f"{self.root}/commits/*/*")) or []:
            if (_name(st.getPath().getParent().getName()), st.getPath().getName().split("-", 1)[1]) not in live:
                self._fs.delete(st.getPath(), False)
        return gone


def _folder(run: str) -> str:
    """A run's folder name: letters, digits and ``-._~`` only, which no reader of partition folders unescapes."""
    return "r" + quote(run, safe="").replace("~", "%7E").replace("%", "~")


def _name(folder: str) -> str:
    return unquote(folder[1:].replace("~", "%"))


def _run(folder: Column) -> Column:
    return F.url_decode(F.replace(F.substring(folder, 2, 1 << 20), F.lit("~"), F.lit("%")))
