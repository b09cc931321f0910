"""zonecast: demand analytics on Apache Spark.

Raw trip records become a gap-free zone x hour history, then features,
forecasts, error reports, drift statistics and usage roll-ups.  Every
public function takes and returns DataFrames.
"""

from zonecast.config import DatasetConfig, load_config, preset
from zonecast.session import clear_stages, materialize, use_utc

__all__ = ["DatasetConfig", "clear_stages", "load_config", "materialize", "preset", "use_utc"]
