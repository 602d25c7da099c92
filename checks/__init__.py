"""Registered queries, their domain tables and their oracle SQL."""


def load_all() -> None:
    from . import q_joins, q_nested, q_rules, q_sources, q_tables, q_vendors  # noqa: F401
