"""All registered queries; importing this module fills the registry."""

from ledgerloom.plans import (  # noqa: F401
    distribution_queries,
    io_queries,
    ledger_queries,
    model_queries,
    profile_queries,
    timeseries_queries,
    walk_queries,
)
from ledgerloom.plans.registry import ORACLES, QUERIES  # noqa: F401
