"""A table of the files below some folders: what is in them, and which ones a rerun has to read.

``(src_file, size, modified, n_lines, n_nonblank, version)``: one row per file, ``version`` the run that counted it.
A refresh lists the folders (Spark's file index, in parallel beyond a few folders; no content is read), takes over the
rows of files whose size and modification time are unchanged, and counts lines in tasks only in the rest.  Files that are
gone leave the table.  Each run writes a new folder ``v=<n>`` and readers take the newest finished one, so a run that
dies leaves the last table as it was.

Up to ``MAX_PATHS`` changed files are read by name; beyond that (a first run over millions of files) the folders
are read whole and joined with the changed names, with the same result and no list on the driver.

Defined cases: empty files are left out (Spark's scans skip them); a folder without matching files gives an empty table;
equal files are counted each; a file that changes without a new size or modification time is not seen.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.functions import text as T
from threadline.sources import jsonl as J

MAX_PATHS = 10_000
FILE_COLS = ["src_file", "size", "modified"]
SCHEMA = "src_file string, size bigint, modified timestamp, n_lines bigint, n_nonblank bigint, version int"
# Characters that a reader would take as a glob.
_GLOB = re.compile(r"[*?\[\]{}\\,]")


def list_files(spark: SparkSession, paths, glob: str | None = J.DEFAULT_GLOB) -> DataFrame:
    """(src_file, size, modified) of every file below ``paths``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select(F.col("_metadata.file_path").alias("src_file"), F.col("length").alias("size"),
                                     F.col("modificationTime").alias("modified"))


def _versions(spark: SparkSession, manifest_dir: str) -> list[int]:
    """Numbers of the finished runs."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{manifest_dir.rstrip('/')}/v=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName()[2:]) for f in found)


def read_manifest(spark: SparkSession, manifest_dir: str) -> DataFrame:
    """The newest finished manifest; empty if there is none."""
    done = _versions(spark, manifest_dir)
    if not done:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{manifest_dir.rstrip('/')}/v={done[-1]}")


def _lines_of(spark: SparkSession, files: DataFrame, paths, glob: str | None) -> DataFrame:
    """Raw lines of ``files`` (a table with ``src_file``), read by name where they are few."""
    names = [r.src_file for r in files.select("src_file").limit(MAX_PATHS + 1).collect()]  # at most MAX_PATHS + 1 names
    plain = [unquote(n) for n in names]
    if not names:
        return J.read_lines(spark, paths, True, glob).limit(0)
    if len(names) <= MAX_PATHS and not any(_GLOB.search(p) for p in plain):
        return J.read_lines(spark, plain)
    return J.read_lines(spark, paths, True, glob).join(files.select("src_file"), "src_file", "left_semi")


def refresh_manifest(spark: SparkSession, paths, manifest_dir: str, glob: str | None = J.DEFAULT_GLOB) -> DataFrame:
    """Bring the manifest up to date with ``paths`` and return it; only new and changed files are read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    done = _versions(spark, manifest_dir)
    version = done[-1] + 1 if done else 1
    target = f"{manifest_dir.rstrip('/')}/v={version}"
    known = read_manifest(spark, manifest_dir)
    # the listing is written first, so that files which change meanwhile are seen by the next run
    list_files(spark, paths, glob).write.mode("overwrite").parquet(f"{manifest_dir.rstrip('/')}/listed/v={version}")
    listed = spark.read.parquet(f"{manifest_dir.rstrip('/')}/listed/v={version}")
    changed = listed.join(known, FILE_COLS, "left_anti")
    counts = (_lines_of(spark, changed, paths, glob).groupBy("src_file")
              .agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(T.is_nonblank("line")).alias("n_nonblank")))
    zero = F.lit(0).cast("bigint")
    new = (changed.join(counts, "src_file", "left")
           .select(*FILE_COLS, F.coalesce("n_lines", zero).alias("n_lines"), F.coalesce("n_nonblank", zero).alias("n_nonblank"),
                   F.lit(version).alias("version")))
    kept = listed.join(known, FILE_COLS).select(*new.columns)
    kept.unionByName(new).write.mode("overwrite").parquet(target)
    return read_manifest(spark, manifest_dir)


def scan_manifest(spark: SparkSession, manifest: DataFrame, paths, where="true", glob: str | None = J.DEFAULT_GLOB) -> DataFrame:
    """Tolerant scan of the files of ``manifest`` that pass ``where`` (SQL or a column over its columns) and are not blank."""
    cond = F.expr(where) if isinstance(where, str) else where
    files = manifest.filter(cond).filter("n_nonblank > 0")
    paths = [paths] if isinstance(paths, str) else list(paths)
    return J.scan_lines(_lines_of(spark, files, paths, glob))
