"""File paths as the Hadoop file sources report them."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def qualified_root(spark: SparkSession, root: str) -> str:
    """The absolute path of ``root`` (``./data`` included) as its file system
    names it, without scheme and trailing slash."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath().rstrip("/")


def decoded_path(col: str) -> Column:
    """``_metadata.file_path`` is URI-encoded; ``+`` is literal in a URI path, so
    it is protected before URL-decoding."""
    return F.url_decode(F.replace(F.col(col), F.lit("+"), F.lit("%2B")))


def relative_path(col: str, root: str) -> Column:
    """The decoded path below ``root`` (see :func:`qualified_root`): what follows
    the scheme, the authority and the root itself."""
    path = F.regexp_replace(decoded_path(col), "^[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?", "")
    return F.when(path.startswith(root + "/"), F.substring(path, len(root) + 2, 1 << 30))
