"""eventmill: a Spark-native event analytics engine.

Raw JSON user events are validated (with a reject reason), de-duplicated, enriched
(time, category, device and location fields) and landed in two shapes (flat analytic
rows and nested documents).  On top sit hourly and daily-user rollups, a fixed set of
analytic queries and lookups, and pipeline-quality metrics kept as ordinary tables.

Everything is written with the public DataFrame / SQL / Structured Streaming APIs so
Catalyst plans all of it; there is no per-row Python on any hot path.
"""

from eventmill.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
__version__ = "0.1.0"
