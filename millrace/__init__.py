"""millrace: lakehouse data-engineering operators for plain Spark and Parquet."""

from millrace.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
