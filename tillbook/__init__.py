"""tillbook: Spark-native analytics for an online shop, a sportsbook and their telemetry.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built from the
DataFrame API, so Catalyst sees the whole plan (pushdown, pruning, AQE).
"""

from tillbook.session import (  # noqa: F401
    EVENTS_AS_OF,
    ORDERS_AS_OF,
    checkpoint_dir,
    configure,
    local_session,
)

__all__ = ["EVENTS_AS_OF", "ORDERS_AS_OF", "checkpoint_dir", "configure", "local_session"]
