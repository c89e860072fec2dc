"""Queries over the sample tables, each with equivalent SQL where SQL can say it.

The sample tables are generic, so every query starts from a transit-shaped view
of one of them (see `views`) and runs over all of its rows.
"""

from tramline.catalogue import files, json_messages, kpi, learning, streams, text

_GROUPS = (kpi, text, json_messages, files, streams, learning)

QUERIES = {name: run for group in _GROUPS for name, run in group.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql.strip() for group in _GROUPS for name, sql in group.oracles().items()}
