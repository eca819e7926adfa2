"""All registered queries; importing a module registers what it holds."""

from tendersift.plans import (queries_normal, queries_notices, queries_runs, queries_screen, queries_similar,  # noqa: F401
                              queries_tables, queries_text)
from tendersift.plans.registry import ORACLE, QUERIES  # noqa: F401
