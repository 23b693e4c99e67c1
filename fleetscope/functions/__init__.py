"""Column-level functions: every one returns a built-in Spark expression."""

from fleetscope.functions.core import (  # noqa: F401
    epoch_micros, epoch_millis, iso_millis, null_if_empty, truncate,
    actor_error, is_reserved_category, partition_key, uuid7_from_key,
    uuid7_is_valid, uuid7_millis,
)
from fleetscope.functions.props import sanitize_properties  # noqa: F401
from fleetscope.functions.delivery import (  # noqa: F401
    attempt_class, backoff_ms, parse_retry_after, is_permanent, is_retryable,
)
from fleetscope.functions.environment import pseudonymize, ram_bucket  # noqa: F401
