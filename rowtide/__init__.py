"""Change-data-capture lake tables built from Spark DataFrames."""

from rowtide.session import build_session, configure, shared_dir
from rowtide.spec import TableSpec

__all__ = ["TableSpec", "build_session", "configure", "shared_dir"]
