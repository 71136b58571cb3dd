"""Named queries over a folder of driver tables, and their SQL oracles."""

from strata.plans.catalog import QUERIES, run_query  # noqa: F401
from strata.plans.oracle import ORACLE_SQL  # noqa: F401
