"""The queries of this folder and the SQL that some of them have to agree with."""

from . import audit, curriculum, jaccard, language, lm, manifest, packing, pieces, pii, quality, rules, urls, vectors  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
