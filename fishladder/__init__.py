"""fishladder: Spark-native analytics for tagged-fish detections, dam
passage counts, window counts and river gauges.

Every operator is a function ``f(df, ...) -> DataFrame`` built from the
DataFrame API, so Catalyst plans, prunes and pushes down the whole chain.
"""

from fishladder.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
