"""The registered queries and the SQL each one has to agree with."""

from . import behaviour, facts, history, learning, market, quality, roundtrips, series, shaping, streams, vectors  # noqa: F401
from .base import ORACLES, QUERIES, Inputs

__all__ = ["ORACLES", "QUERIES", "Inputs"]
