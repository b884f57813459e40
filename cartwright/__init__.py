"""Commerce analytics pipelines as composable PySpark DataFrame operators."""

from cartwright.session import build_session, shared_dir, tune

__all__ = ["build_session", "shared_dir", "tune"]
