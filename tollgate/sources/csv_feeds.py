"""CSV feed scans keyed by header names, over any number of bundles.

Layout: ``<root>/<bundle>/<feed>.csv``. One feed across all bundles is read
by a glob in a few scans, one per distinct header signature (files are
grouped by their header line, so a file that lacks a column never shifts
values into the wrong column), then ``unionByName`` aligns them. ``bundle``
is taken from the parent folder of each file.

Everything is read as strings; pandas' NA tokens become null; declared types
are applied with ``try_cast`` (see ``typed_view``), so a bad value becomes a
dtype-audit finding instead of a failed job. A doubled quote inside quotes is
one quote. With ``multi_line`` (the default, the same for every file and size)
a quoted field may hold line breaks; a file is then one task's work, so large
feeds should arrive as many files. Without it a line with an unclosed quote is
malformed. A record with more fields than the header is malformed, too; both
are counted per bundle (``malformed_rows``).
"""

from __future__ import annotations

import contextlib
import csv
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import NA_TOKENS, na_to_null, try_cast_typed
from ..operators.schema import SchemaDefinition, _spark_type_name
from ..session import cut_lineage

FILE_COL = "_source_file"
MTIME_COL = "_file_mtime"
SIZE_COL = "_file_size"
ORDER_COL = "_row_order"
BUNDLE_COL = "bundle"

SURPLUS_COL = "_surplus"

# One file per task, so that a task can stop after its file's first rows.
WHOLE_FILE_BYTES = 1 << 40


@contextlib.contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def plain_path(path: Column) -> Column:
    """A file path as written: metadata paths are URL-encoded (a plus is not a space there)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def bundle_of(path: Column) -> Column:
    """Parent folder name of a (plain) file path."""
    return F.element_at(F.split(path, "/"), -2)


def _file_path() -> Column:
    return plain_path(F.col("_metadata.file_path"))


def read_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: file_path, bundle, file_name, columns (array<string>).

    Every file is one task, which ends after the first batch of lines, so
    tasks follow the number of files and bytes read follow the headers, not
    the data. The rows are written once as a small table.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)

    # Defined here so it is shipped by value to the Python workers (no need
    # to install this package on executors).
    def header_of_file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                line = pdf["header"].iloc[0].removeprefix("\ufeff")
                names = [c.strip() for c in next(csv.reader([line]), [])]
                yield pd.DataFrame({"file_path": [pdf["file_path"].iloc[0]], "columns": [names]})
                return

    lines = spark.read.text(paths).select(_file_path().alias("file_path"), F.col("value").alias("header"))
    first = lines.mapInPandas(header_of_file, "file_path string, columns array<string>")
    out = first.select("file_path", bundle_of(F.col("file_path")).alias(BUNDLE_COL),
                       F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "columns")
    with whole_files(spark):
        return cut_lineage(out.hint("rebalance"), spark)


@contextlib.contextmanager
def whole_files(spark: SparkSession):
    """One file per scan task."""
    with _conf(spark, "spark.sql.files.maxPartitionBytes", str(WHOLE_FILE_BYTES)), \
            _conf(spark, "spark.sql.files.openCostInBytes", str(WHOLE_FILE_BYTES)):
        yield


def header_signatures(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(columns, files) per distinct header; one small action.

    The driver receives one (header, file name) row per file — the same
    listing Spark's file index keeps on the driver to plan any read — never
    file contents, and no task gathers all names into one row.
    """
    rows = read_headers(spark, paths).select("columns", "file_path").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in rows:
        groups.setdefault(tuple(r["columns"]), []).append(r["file_path"])
    return [(list(cols), sorted(files)) for cols, files in groups.items()]


def read_feed(spark: SparkSession, paths: str | Sequence[str], na_tokens=NA_TOKENS,
              signatures: list[tuple[list[str], list[str]]] | None = None,
              multi_line: bool = True) -> DataFrame | None:
    """Read every file of one feed by header; all columns as strings.

    Adds ``bundle``, ``_source_file``, ``_file_mtime``, ``_file_size``, ``_row_order``
    (file order inside each file) and ``_surplus`` (the first field beyond the
    header, null for a well-formed record). Returns None when no file matches.
    """
    sigs = signatures if signatures is not None else header_signatures(spark, paths)
    frames = []
    for columns, files in sigs:
        schema = ", ".join(f"`{c}` string" for c in [*columns, SURPLUS_COL])
        df = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("enforceSchema", True).schema(schema).csv(files))
        df = df.select(
            *[na_to_null(F.col(f"`{c}`"), na_tokens).alias(c) for c in columns],
            bundle_of(_file_path()).alias(BUNDLE_COL),
            _file_path().alias(FILE_COL),
            F.col(SURPLUS_COL),
            F.col("_metadata.file_modification_time").alias(MTIME_COL),
            F.col("_metadata.file_size").alias(SIZE_COL),
            F.struct(_file_path().alias("f"),
                     F.col("_metadata.file_block_start").alias("b"),
                     F.monotonically_increasing_id().alias("i")).alias(ORDER_COL))
        frames.append(df)
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def unclosed_quotes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(bundle, unclosed) lines with an odd number of quotes, per bundle; for reads without ``multi_line``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    return (spark.read.text(paths).select(bundle_of(_file_path()).alias(BUNDLE_COL), odd.cast("long").alias("odd"))
            .groupBy(BUNDLE_COL).agg(F.sum("odd").alias("unclosed")))


def typed_view(raw: DataFrame, definition: SchemaDefinition) -> DataFrame:
    """Declared columns try-cast to their types (absent ones are null)."""
    typed = definition.typed_columns()
    present = set(raw.columns)
    out = []
    for c in definition.required_columns:
        t = _spark_type_name(typed[c])
        if c in present:
            out.append(try_cast_typed(F.col(f"`{c}`"), t).alias(c))
        else:
            out.append(F.lit(None).cast(t).alias(c))
    extra = [c for c in raw.columns if c not in set(definition.required_columns)]
    return raw.select(*out, *[F.col(f"`{c}`") for c in extra])


GLOB_CHUNK = 500


def feed_glob(data_root: str, file_name: str, bundles: str | Sequence[str] = "*") -> list[str]:
    """Glob(s) for one feed: a pattern, or a bundle list folded into brace
    alternations (``{a,b,...}``) of ``GLOB_CHUNK`` names, so a long list costs
    a few file-system globs instead of one per bundle."""
    root = data_root.rstrip("/")
    if isinstance(bundles, str):
        return [f"{root}/{bundles}/{file_name}"]
    names = list(bundles)
    plain = [b for b in names if any(ch in b for ch in ",{}")]
    fold = [b for b in names if b not in set(plain)]
    out = [f"{root}/{b}/{file_name}" for b in plain]
    for i in range(0, len(fold), GLOB_CHUNK):
        part = fold[i:i + GLOB_CHUNK]
        alt = part[0] if len(part) == 1 else "{" + ",".join(part) + "}"
        out.append(f"{root}/{alt}/{file_name}")
    return out


def load_bundles(spark: SparkSession, data_root: str, definitions: Sequence[SchemaDefinition],
                 bundles: str | Sequence[str] = "*",
                 multi_line: bool = True) -> dict[str, tuple[DataFrame | None, DataFrame]]:
    """feed name -> (raw string frame over all bundles, headers frame).

    The header lines of every feed's files are read in ONE small job; files
    are then grouped per feed (by file name) and per header signature.
    """
    paths = {d.name: _existing(spark, feed_glob(data_root, d.file_name, bundles)) for d in definitions}
    every = [p for ps in paths.values() for p in ps]
    out: dict[str, tuple[DataFrame | None, DataFrame | None]] = {d.name: (None, None) for d in definitions}
    if not every:
        return out
    # One row per file, written once as a small table (a distributed frame
    # for the per-bundle header checks; never a driver-built local relation).
    table = read_headers(spark, every)
    by_name: dict[str, dict[tuple[str, ...], list[str]]] = {}
    for r in table.select("file_name", "columns", "file_path").collect():
        by_name.setdefault(r["file_name"], {}).setdefault(tuple(r["columns"]), []).append(r["file_path"])
    for d in definitions:
        groups = by_name.get(d.file_name, {})
        if not paths[d.name] or not groups:
            continue
        sigs = [(list(cols), sorted(files)) for cols, files in groups.items()]
        raw = read_feed(spark, paths[d.name], signatures=sigs, multi_line=multi_line)
        out[d.name] = (raw, table.where(F.col("file_name") == d.file_name))
    return out


def _existing(spark: SparkSession, globs: Sequence[str]) -> list[str]:
    """Keep globs that match at least one file (Hadoop glob on the driver)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for g in globs:
        p = jvm.org.apache.hadoop.fs.Path(g)
        found = p.getFileSystem(conf).globStatus(p)
        if found is not None and len(found) > 0:
            out.append(g)
    return out


def file_times(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(bundle, newest file time) of the files that match, from the listing alone."""
    return (spark.read.format("binaryFile").load(list(paths)).select(bundle_of(F.col("path")).alias(BUNDLE_COL), "modificationTime")
            .groupBy(BUNDLE_COL).agg(F.max("modificationTime").alias(MTIME_COL)))
