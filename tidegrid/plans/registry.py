"""A query and its SQL side by side."""

from __future__ import annotations

#: The observations table of ``sources.tables.observations`` in SQL.
OBS = "obs AS (SELECT event_id AS id, user_id AS k, event_type AS track, ts, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS day, value AS v FROM events)"


def registry():
    """(queries, sql, decorator): ``@query(sql)`` registers a function under its own name."""
    queries, sql = {}, {}

    def query(text: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if text:
                sql[f.__name__] = text.replace("{obs}", "WITH " + OBS)
            return f

        return add

    return queries, sql, query
