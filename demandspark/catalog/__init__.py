"""Registered queries and their SQL twins over the driver's tables."""

from demandspark.catalog import (  # noqa: F401  (importing a module registers its queries)
    analysis, chains, cleaning, dashboard, decomposition, features, inventory, learning, live, sinks,
)
from demandspark.catalog.base import QUERIES, SQL_TWINS  # noqa: F401
