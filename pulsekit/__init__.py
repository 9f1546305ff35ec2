"""pulsekit: behaviour analytics on Spark DataFrames and Structured Streaming.

Every operator takes DataFrames and column names and returns a DataFrame built
from Spark column expressions, joins, aggregations and window functions.
"""

from pulsekit.session import checkpoint_dir, ensure_utc, get_session

__all__ = ["checkpoint_dir", "ensure_utc", "get_session"]
