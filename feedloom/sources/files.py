"""File listings and checks on requested files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schema import EXTENSIONS

# Fixed values ---------------------------------------------------------------
ABSENT = "Data file does not exist: "
# ----------------------------------------------------------------------------


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    target, fs = _hadoop_path(spark, path)
    fs.delete(target, True)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether there is a regular file of this name; a folder or a pattern is none."""
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def has_children(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and is not empty; asks for its first entries only."""
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target) and fs.listStatusIterator(target).hasNext()


def list_files(spark: SparkSession, globs: str | Sequence[str]) -> DataFrame:
    """Files matching the globs as ``(path, size)``, empty ones included.

    Spark's own file scans leave empty files out, so the listing is asked of the
    file system: names and sizes only, no content. Meant for requested files,
    not for the parts of a large folder.
    """
    rows = []
    for glob in [globs] if isinstance(globs, str) else globs:
        target, fs = _hadoop_path(spark, glob)
        for status in fs.globStatus(target) or []:
            if status.isFile():
                rows.append((plain(status.getPath().toString()), status.getLen()))
    return spark.createDataFrame(sorted(set(rows)), "path string, size bigint")


def source_problem(spark: SparkSession, source: str | Sequence[str], kind: str) -> str | None:
    """What keeps a feed's files from being read as ``kind``: none there, a wrong ending, an empty one.

    Files named by the source, or matched by its patterns, are checked one by
    one; of folders only that they are there.
    """
    for glob in [source] if isinstance(source, str) else source:
        target, fs = _hadoop_path(spark, glob)
        if not fs.globStatus(target):
            return f"{ABSENT}{glob}"
    files = list_files(spark, source)
    checked = check_files(files.select("path", F.lit(kind).alias("file_type")), files)
    row = checked.where("problem IS NOT NULL").orderBy("path").first()
    return None if row is None else row["problem"]


def plain(path: str) -> str:
    """A local path without its scheme."""
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def plain_path(c: Column) -> Column:
    """``plain`` for a column of paths."""
    return F.regexp_replace(c, r"\Afile:/+", "/")


def normalized(path: Column, root: str) -> Column:
    """An absolute path without ``.`` and ``..``; a relative one is taken from ``root``."""
    p = F.trim(path)
    full = F.when(p.startswith("/"), p).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), p))
    steps = F.filter(F.split(full, "/"), lambda s: ~s.isin("", "."))
    folded = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(
            F.concat(done, F.array(s))
        ),
    )
    return F.concat(F.lit("/"), F.array_join(folded, "/"))


def inside(path: Column, root: str) -> Column:
    """Whether a path stays below ``root`` once normalized."""
    base = F.lit(root.rstrip("/"))
    resolved = normalized(path, root)
    return (resolved == base) | resolved.startswith(F.concat(base, F.lit("/")))


def needs_split(size: Column, threshold: Column | int) -> Column:
    """Only files larger than the threshold are split."""
    return size > threshold


def check_files(requests: DataFrame, listing: DataFrame, root: str | None = None) -> DataFrame:
    """Requests ``(path, file_type)`` with ``size`` and ``problem`` (NULL when the file can be read)."""
    joined = requests.join(listing, "path", "left")
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.upper(F.trim("file_type"))
    extension = F.lit(None).cast("string")
    for file_type, ending in EXTENSIONS.items():
        extension = F.when(kind == file_type, F.lit(ending)).otherwise(extension)
    outside = F.lit(False) if root is None else ~inside(F.col("path"), root)
    problem = (
        F.when(outside, F.lit(f"path must be inside {root}"))
        .when(
            extension.isNull(),
            F.concat(F.lit("Unsupported fileType "), F.col("file_type"), F.lit("; expected CSV or JSON")),
        )
        .when(F.col("size").isNull(), F.concat(F.lit(ABSENT), F.col("path")))
        .when(
            ~F.lower(name).endswith(extension),
            F.concat(F.lit("Data file must end with "), extension, F.lit(" for fileType "), kind, F.lit(": "), name),
        )
        .when(F.col("size") == 0, F.concat(F.lit("Data file is empty: "), F.col("path")))
    )
    return joined.withColumn("problem", problem)
