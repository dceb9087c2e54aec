"""Every registered query, with its DuckDB twin where SQL can state it."""

from riskflow.queries.registry import oracles, registered
from riskflow.queries import tables, cleaning, profiling, encoding, splitting, evaluation, gating, runs, models  # noqa: F401, E402

__all__ = ["oracles", "registered"]
