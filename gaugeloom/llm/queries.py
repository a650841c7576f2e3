"""All registered queries of the subpackage, and the SQL they are compared with."""

from gaugeloom.llm import (  # noqa: F401
    bytecnn, crossparse, hardnegatives, jaccard, licences, linechunks, maxscore, packing, pseudonyms, resampling, templates, tokens, toxicity)
from gaugeloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
