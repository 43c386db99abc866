"""Registered queries over the test tables, each next to its check in SQL.

A module offers ``QUERIES`` (name to function of session and table folder) and
``SQL`` (name to the same result for another engine). Names without SQL are
checked by row count here and by invariants in the tests.
"""

from . import clustering, corpus, headings, markdown, storage, summaries, terms

_MODULES = (terms, headings, markdown, summaries, storage, clustering)


def queries():
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def oracle_sql():
    return {name: text for module in _MODULES for name, text in module.SQL.items()}


__all__ = ["corpus", "oracle_sql", "queries"]
