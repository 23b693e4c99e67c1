"""fleetscope: product-usage telemetry analytics on Spark.

Turns raw logs of application calls (track, identify, sessions, exceptions,
consent, reset) and of delivery attempts into validated events, resolved
actors, identity links, sessions, exception reports with breadcrumbs,
delivery batches and delivery outcomes. Every operator is a
``DataFrame -> DataFrame`` function built from Spark SQL expressions,
joins and windows, keyed by ``install_id``.
"""

from fleetscope.config import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
