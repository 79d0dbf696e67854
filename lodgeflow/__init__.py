"""lodgeflow — a Spark-native rental-marketplace analytics pipeline.

Everything is a plain function over Spark DataFrames: staging and cleansing
(``plans.models``), incremental and SCD-2 loads (``operators.load``,
``operators.scd2``), data-quality checks (``operators.checks``), anomaly
detection (``operators.anomaly``), a table profiler (``operators.profile``)
and dependency impact analysis (``operators.lineage``).
"""

from lodgeflow.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
