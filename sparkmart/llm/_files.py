"""Files that tasks write and read themselves, in the shared folder."""

from __future__ import annotations

import re

import pyarrow.fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder's URI; a plain path is a local one."""
    m = re.match(r"file:/*(/.*)", uri)
    if m or uri.startswith("/"):
        return pafs.LocalFileSystem(), m[1] if m else uri
    return pafs.FileSystem.from_uri(uri)


def qualified(spark, path: str) -> str:
    """``path`` as a full URI of the session's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
