"""Every query of the library and its SQL twin, by name."""

from __future__ import annotations

from corpusloom.plans import crawling, reviewing, storing, text, web

PLANS = (text, web, crawling, reviewing, storing)
QUERIES: dict = {name: query for plan in PLANS for name, query in plan.QUERIES.items()}
ORACLE_SQL: dict = {name: sql for plan in PLANS for name, sql in plan.ORACLE_SQL.items()}
