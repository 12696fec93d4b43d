"""All registered queries and the SQL they are checked against."""

from __future__ import annotations


def _load():
    from commentscope.catalog import base, corpus_queries, model_queries, text_queries  # noqa: F401
    return base


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().ORACLE)
