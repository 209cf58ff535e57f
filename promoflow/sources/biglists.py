"""Big-list files (S7): item, store and member lists kept as CSV files.

All the files a batch needs are read in one scan; the file path becomes the list key, so
joining events to their lists is an equi-join instead of one read per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TWO_TEXT_COLUMNS = T.StructType([T.StructField("c0", T.StringType()),
                                  T.StructField("c1", T.StringType())])


def read_biglists(spark: SparkSession, paths: list[str], header: bool = False,
                  base: str | None = None) -> DataFrame:
    """(list_key, c0, c1) rows of the given CSV files.

    ``c0`` is the first column (item, store or card number), ``c1`` the second if any
    (propensity).  With ``base``, list keys are the paths relative to it, matching the
    list locations events carry.  Headers are dropped by the reader when ``header``.
    """
    if not paths:
        return spark.createDataFrame([], "list_key string, c0 string, c1 string")
    df = (spark.read.schema(_TWO_TEXT_COLUMNS)
          .option("header", str(header).lower())
          .option("mode", "PERMISSIVE")
          .csv(paths))
    key = F.col("_metadata.file_path")
    if base:
        prefix = base.rstrip("/") + "/"
        key = F.regexp_replace(key, r"^(file:)?/*" + _escape(prefix.lstrip("/")), "")
    return df.select(key.alias("list_key"), F.trim("c0").alias("c0"), F.trim("c1").alias("c1"))


def read_list_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(list_key, file, cells) of every line of the list files under ``folder``, layout open.

    A list is one file or a folder of part files; its key is its path below ``folder``.
    Cells are cut at commas and trimmed of blanks and quotes (card, item and store numbers
    and propensities hold neither).
    """
    root = r"^(file:)?/*" + _escape(folder.rstrip("/").lstrip("/") + "/")
    path = F.regexp_replace(F.col("_metadata.file_path"), root, "")
    cells = F.transform(F.split(F.regexp_replace("value", "^\uFEFF", ""), ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    return (spark.read.option("recursiveFileLookup", "true").text(folder)
            .select(F.regexp_replace(path, "/part-[^/]*$", "").alias("list_key"), path.alias("file"), cells.alias("cells")))


def _is_header(cells, name: str):
    return F.exists(cells, lambda c: F.lower(c) == name.lower())


def named_columns(lines: DataFrame, first: str, second: str) -> DataFrame:
    """(list_key, c0, c1) of files with a header: the columns called ``first`` and ``second``
    (NULL where there is none), in whatever order each file has them.  A file whose header
    does not name ``first`` gives no row; see ``list_manifest``."""
    place = lambda name: F.array_position(F.transform("cells", F.lower), name.lower()).cast("int")
    heads = (lines.filter(_is_header("cells", first)).groupBy("file").agg(F.min("cells").alias("cells"))
             .select("file", place(first).alias("p0"), place(second).alias("p1")))
    rows = lines.filter(~_is_header("cells", first)).join(heads, "file")
    at = lambda p: F.when(F.col(p) > 0, F.get("cells", F.col(p) - 1))
    return rows.select("list_key", at("p0").alias("c0"), at("p1").alias("c1"))


def unnamed_column(lines: DataFrame) -> DataFrame:
    """(list_key, c0, c1) of files without header and with one column."""
    return lines.select("list_key", F.get("cells", F.lit(0)).alias("c0"), F.lit(None).cast("string").alias("c1"))


def list_manifest(lines: DataFrame, first: str) -> DataFrame:
    """(list_key, named) of the lists that have lines; ``named``: each of its files has a
    header that names ``first``, so events whose source reads by name can use it."""
    per_file = lines.groupBy("list_key", "file").agg(F.max(_is_header("cells", first)).alias("named"))
    return per_file.groupBy("list_key").agg(F.min("named").alias("named"))


def _escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)




def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """(list_key) of the non-empty list files under ``folder``, relative to it.

    A distributed listing: the binary-file source with only the path column selected does
    not read file contents.  Spark's file scans skip zero-length files, so an empty list
    file is not listed (and would count as unreadable); callers that must accept empty
    files pass their own manifest of available files instead.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(folder).select("path"))
    prefix = folder.rstrip("/").lstrip("/") + "/"
    return df.select(F.regexp_replace("path", r"^(file:)?/*" + _escape(prefix), "").alias("list_key"))
