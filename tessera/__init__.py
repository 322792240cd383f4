"""tessera — Spark-native operators for feature building, scoring and monitoring.

Every operator is a pure function from DataFrames (plus parameters) to a
DataFrame.  Nothing is collected to the driver except tiny, size-bounded
sketches (range bounds, category code tables that were counted first).
"""

from tessera.session import get_session, scratch_path  # noqa: F401

__version__ = "0.1.0"
