"""Registered queries: name -> f(spark, sf_dir) -> DataFrame, and the same result as SQL."""

from __future__ import annotations

from barloom.plans import analytics, bars, catalogs, jobs, more, streams, tables, units

QUERIES = bars.QUERIES | analytics.QUERIES | catalogs.QUERIES | streams.QUERIES | tables.QUERIES | more.QUERIES | units.QUERIES | jobs.QUERIES
ORACLE_SQL = bars.ORACLE_SQL | analytics.ORACLE_SQL | catalogs.ORACLE_SQL | streams.ORACLE_SQL | tables.ORACLE_SQL | more.ORACLE_SQL | units.ORACLE_SQL | jobs.ORACLE_SQL
