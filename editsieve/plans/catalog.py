"""Importing the query modules fills the registry."""

from . import events, filters, similarity, streams, texts  # noqa: F401
from .registry import QUERIES

__all__ = ["QUERIES"]
