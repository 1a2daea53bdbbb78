"""market_engine: Spark-native analytics for hourly power-price stress.

Layers (all lazy DataFrame functions; nothing is collected to the driver):

* ``sources``   landed archives / CSV / JSON pages, table reads, test adapters
* ``functions`` column-level helpers (keys, hour buckets, exact averages, rounding, parsing)
* ``operators`` hourly roll-ups, features, thresholds, dashboard, quality, ML, reports
* ``plans``     composed jobs (staging -> features -> mart -> dashboard)
* ``sinks``     idempotent partition replace, append, materialise, audit
* ``streaming`` incremental ingest and streaming roll-ups
"""

from market_engine.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
