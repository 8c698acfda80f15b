"""Import every query module so its ``@query`` registrations run."""

from senslake.plans import (q_air, q_csv, q_files, q_legacy, q_load, q_misc, q_stats,  # noqa: F401
                            q_stream, q_study, q_wearable)
from senslake.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
