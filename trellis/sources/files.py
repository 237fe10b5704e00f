"""a folder tree of text files as a ``files(path, contents)`` table.

Each file is read whole (``wholetext``), the folder is walked recursively,
and the path is taken from the scan's ``_metadata.file_path`` relative to
the root folder, under the root name (``/static/...``).  Files are split
across tasks by the file scan; nothing passes through the driver.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.functions.paths import ROOT_NAME


def _uri_prefix(root_dir: str) -> str:
    if "://" in root_dir or root_dir.startswith("file:"):
        return root_dir.rstrip("/") + "/"
    return "file:" + os.path.abspath(root_dir).rstrip("/") + "/"


def load_files(spark: SparkSession, root_dir: str, root_name: str = ROOT_NAME) -> DataFrame:
    """``(path, contents)`` for every file below ``root_dir``."""
    # an argument: the reader's own default would override an option of that name
    raw = (spark.read.option("recursiveFileLookup", True).text(root_dir, wholetext=True)
           .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("contents")))
    prefix = _uri_prefix(root_dir)
    # the scan reports file:/x or file:///x depending on the file system; normalise both
    fp = F.regexp_replace("file_path", "^file:/+", "file:/")
    pre = prefix.replace("file:///", "file:/")
    rel = F.when(fp.startswith(pre), F.substring(fp, len(pre) + 1, 1 << 30))
    return raw.select(F.concat(F.lit("/" + root_name + "/"), F.url_decode(rel)).alias("path"), "contents")
