"""commentscope: analytics and multi-label classification of comment tables on Spark."""

from commentscope.session import build_session

__all__ = ["build_session"]
