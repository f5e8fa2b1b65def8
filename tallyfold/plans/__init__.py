"""Queries over the driver's tables, each with the SQL that says the same."""

from tallyfold.plans import analytics, files, label_plane, matching, views  # noqa: F401
from tallyfold.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
