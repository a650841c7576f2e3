"""Queries over the provided tables, each next to the SQL that must give the same rows.

Tables are read whole. Payload jobs build reply texts from table rows and parse them back, so the SQL can
state the answer directly.
"""

from gaugeloom.queries.common import ORACLES, QUERIES
from gaugeloom.queries import database, payloads, points, streams  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
