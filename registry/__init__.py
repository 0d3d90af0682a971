"""Queries over the test tables, each with the SQL that checks it where SQL can."""

from registry import cleaning, comparison, profiling, reports, sampling, shaping, synthesis

MODULES = (cleaning, profiling, sampling, shaping, comparison, synthesis, reports)


def all_queries():
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def all_sql():
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
