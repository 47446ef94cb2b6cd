"""Tidemark: market-trend and news-sentiment features as Spark DataFrame jobs."""

from tidemark.session import build_session, scratch_folder

__all__ = ["build_session", "scratch_folder"]
