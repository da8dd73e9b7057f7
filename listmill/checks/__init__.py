"""Registered queries over the supplied tables."""


def load():
    """All queries and their SQL."""
    from listmill.checks import (  # noqa: F401
        documents,
        fields,
        jobs,
        market,
        places,
        records,
        registry,
        search,
        streams,
    )

    return registry.QUERIES, registry.ORACLES
