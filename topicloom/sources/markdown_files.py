"""Directory of Markdown files to a table of whole texts."""

import os
import re
from itertools import islice
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

SUFFIX = ".md"


def _without_scheme(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def root_path(root: str) -> str:
    """Absolute form of a root folder, without a trailing separator."""
    plain = root if "://" in root or root.startswith("file:") else os.path.abspath(root)
    return plain.rstrip("/\\")


def relative_path(path, root: str) -> Column:
    """Part of a file path below ``root``."""
    path = F.col(path) if isinstance(path, str) else path
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.substring(bare, F.lit(len(_without_scheme(root_path(root))) + 2), F.length(bare))


def file_key(relative) -> Column:
    """Key of a file: folders and name joined by hyphens."""
    relative = F.col(relative) if isinstance(relative, str) else relative
    return F.regexp_replace(relative, r"[/\\]", "-")


def file_level(relative) -> Column:
    """Depth of a file, one for those right in the root."""
    relative = F.col(relative) if isinstance(relative, str) else relative
    return F.size(F.split(relative, r"[/\\]"))


def scan_markdown(spark: SparkSession, root: str, suffix: str = SUFFIX,
                  skip_hidden_names: bool = False) -> DataFrame:
    """Recursively read the files ending in ``suffix`` as (path, content).

    Folders starting with a dot are skipped, all other names are read. With
    ``skip_hidden_names`` Spark's own reader is used, which also passes over names
    starting with ``_`` and files starting with a dot.
    """
    if not skip_hidden_names:
        return _scan_all(spark, root_path(root), suffix)
    files = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(root_path(root))
    )
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return files.select(F.url_decode(encoded).alias("path"), F.col("value").alias("content"))


def file_listing(files: DataFrame, root: str) -> DataFrame:
    """Distinct (level, file, fileName) of scanned files.

    Unsorted; order by the three columns where the listing is shown.
    """
    relative = relative_path("path", root)
    return files.select(
        file_level(relative).alias("level"),
        F.col("path").alias("file"),
        file_key(relative).alias("fileName"),
    ).dropDuplicates()


def with_file_key(files: DataFrame, root: str) -> DataFrame:
    """Add ``File``; the full path stays for corpora in which keys collide."""
    return files.withColumn("File", file_key(relative_path("path", root)))


# Paths, and bytes of content, that a task hands on at once.
_PATHS, _BYTES = 1000, 8 << 20


def _reader(suffix):
    """Functions that list and read below an address.

    They are made here, and not at module level, so that they travel to the
    tasks by value and the package need not be installed there.
    """

    def open_system(uri):
        if "://" in uri and not uri.startswith("file:"):
            return fs.FileSystem.from_uri(quote(uri, safe=":/@"))
        return fs.LocalFileSystem(), re.sub("^file:(//)?", "", uri)

    def entries(uri):
        """Files and folders right in ``uri``, without folders starting with a dot."""
        system, base = open_system(uri)
        for info in system.get_file_info(fs.FileSelector(base)):
            name = info.path.rstrip("/").rsplit("/", 1)[-1]
            is_dir = info.type == fs.FileType.Directory
            if not name.startswith(".") if is_dir else name.endswith(suffix):
                yield f"{uri}/{name}", is_dir

    def read(uri):
        system, name = open_system(uri)
        with system.open_input_stream(name) as stream:
            return stream.read().decode("utf-8", errors="replace")

    return entries, read


def _scan_all(spark, root, suffix):
    """List the tree level by level in tasks, then read in tasks.

    Each level is stored, so nothing is listed twice; the driver sees the root's
    own name only. Paths are shuffled before reading, so a folder with most of
    the files is read by all tasks.
    """
    entries, read = _reader(suffix)
    slots = spark.sparkContext.defaultParallelism
    parts = max(slots, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def list_folders(batches):
        for batch in batches:
            for folder in batch["path"]:
                found = entries(folder)
                while chunk := list(islice(found, _PATHS)):
                    yield pd.DataFrame(chunk, columns=["path", "is_dir"])

    def read_files(batches):
        for batch in batches:
            paths, texts, size = [], [], 0
            for path in batch["path"]:
                paths.append(path)
                texts.append(read(path))
                size += len(texts[-1])
                if size >= _BYTES:
                    yield pd.DataFrame({"path": paths, "content": texts})
                    paths, texts, size = [], [], 0
            yield pd.DataFrame({"path": paths, "content": texts}, dtype=str)

    folders, files = spark.createDataFrame([(root,)], "path string"), None
    while True:
        level = materialize(folders.mapInPandas(list_folders, "path string, is_dir boolean"), "listing")
        here = level.filter("NOT is_dir").select("path")
        files = here if files is None else files.unionByName(here)
        folders = level.filter("is_dir").select("path")
        if folders.isEmpty():
            break
        folders = folders.repartition(slots)
    return files.repartition(parts).mapInPandas(read_files, "path string, content string")
