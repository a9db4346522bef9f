"""All registered queries."""


def _load():
    from . import explore, features, models, sources, store, windows  # noqa: F401
    from .catalog import QUERIES, SQL
    return QUERIES, SQL


def queries():
    return dict(_load()[0])


def oracle_sql():
    return dict(_load()[1])
