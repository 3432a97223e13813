"""tidebook: retail sales analytics written as Spark DataFrame transformations."""

from tidebook.session import build_session

__all__ = ["build_session"]
