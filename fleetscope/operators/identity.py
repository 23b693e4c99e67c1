"""Identity links (device -> identified actor) and identity stitching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.core import iso_millis


def identity_links(state: DataFrame) -> DataFrame:
    """A link on each accepted ``identify`` that changes the actor.

    ``identify(a)`` links the current device to ``a`` only when the actor
    before it differs (a ``start_session(a)`` earlier sets the actor without
    a link). The first link of a device wins; a later link of the same
    device to another actor is a ``conflict`` (the collector refuses it).
    The winner is a per-device partial aggregate joined back on the device.
    """
    ids = state.filter(F.col("accepted") & (F.col("op") == "identify")
                       & (F.coalesce(F.col("actor_before"), F.lit("")) != F.col("explicit_actor")))
    links = ids.select(
        "install_id", "ts", "seq", "epoch",
        F.col("device_id").alias("anonymous_actor_id"),
        F.col("explicit_actor").alias("identified_actor_id"),
        "source_app", "source_version")
    winners = (links.groupBy("anonymous_actor_id")
                    .agg(F.min(F.struct("ts", "seq", "identified_actor_id"))["identified_actor_id"].alias("winner")))
    return (links.join(winners, "anonymous_actor_id", "left")
                 .select("install_id", "ts", "seq", "epoch", "anonymous_actor_id", "identified_actor_id",
                         iso_millis("ts").alias("identified_at"), "source_app", "source_version",
                         (F.col("identified_actor_id") != F.col("winner")).alias("conflict")))


def stitch_identity(events: DataFrame, links: DataFrame) -> DataFrame:
    """Rewrite anonymous (device) actors of events to the identified actor
    their device was first linked to; other events keep their actor.

    Equi-join on the actor id; the link side has one row per device.
    """
    won = (links.filter(~F.col("conflict"))
                .select("anonymous_actor_id", "identified_actor_id")
                .dropDuplicates(["anonymous_actor_id"]))
    j = events.join(won, events["actor_id"] == won["anonymous_actor_id"], "left")
    return j.select(*[events[c] for c in events.columns],
                    F.coalesce(won["identified_actor_id"], events["actor_id"]).alias("stitched_actor_id"))
