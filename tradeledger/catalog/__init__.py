"""Queries over the given tables, one key per operator or plan."""


def load():
    """All queries and their check texts."""
    from tradeledger.catalog import analytic, composite, relational  # noqa: F401
    from tradeledger.catalog.registry import QUERIES, check_texts

    return dict(QUERIES), check_texts()
