"""tripmart: a Spark-native trip lakehouse.

Raw trips and a zone lookup become Bronze, a classified Silver layer with a
quarantine and per-metric eligibility, a Gold star schema, and validation /
KPI reports. Every operator is a pure ``DataFrame -> DataFrame`` function
built from native Spark expressions; no Python UDF runs in any hot path.
"""

from tripmart.config import RunConfig

__all__ = ["RunConfig"]
