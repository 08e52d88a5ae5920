"""The queries over the Parquet tables, and their SQL twins."""

# Importing a module registers its queries.
from ledgerloom.queries import catalogue, cleaning, incremental, relational, star, validation
from ledgerloom.queries.registry import ORACLES, QUERIES, Tables

__all__ = [
    "ORACLES",
    "QUERIES",
    "Tables",
    "catalogue",
    "cleaning",
    "incremental",
    "relational",
    "star",
    "validation",
]
