"""Layered (bronze / silver / gold) commerce analytics on Spark."""

from lakelayers.context import Context
from lakelayers.session import build_session

__all__ = ["Context", "build_session"]
