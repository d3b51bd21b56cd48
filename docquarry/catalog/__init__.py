"""The registered queries: each a Spark job over the given tables with its SQL twin."""

from . import batches, exact, facets, loading, nested, pages, presentation, scores, text  # noqa: F401  (importing registers the queries)
from .base import QUERIES, SQL  # noqa: F401
