"""Training-data operators: thirteen operators over documents, pages, queries and embeddings.

Nothing outside this subpackage imports it.  ``queries()`` and ``oracle_sql()``
list the ``opN_*`` queries (and the corpus pipeline) for ``__spark_entry__``.
"""

from __future__ import annotations


def queries() -> dict:
    """``opN_<name>`` -> callable(spark, sf_dir), plus ``pipeline``."""
    from pelagic.llm import catalog as q

    return dict(q.QUERIES)


def oracle_sql() -> dict:
    """DuckDB SQL of the queries that SQL can express."""
    from pelagic.llm import catalog as q

    return dict(q.ORACLES)
