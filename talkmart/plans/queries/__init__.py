"""Named queries over the given tables. Importing this package registers them all."""

from talkmart.plans.queries import checks, mart, scored, sentences, states, stored_pages, windows  # noqa: F401
from talkmart.plans.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
