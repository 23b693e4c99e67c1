"""Property map cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope import config as C


def sanitize_properties(props, max_entries: int = C.MAX_PROPERTIES,
                        key_len: int = C.MAX_PROPERTY_KEY_LEN,
                        value_len: int = C.MAX_PROPERTY_VALUE_LEN) -> Column:
    """Clean a ``map<string,string>`` of event properties.

    Entries with an empty value are skipped and do not count; of the rest
    the first ``max_entries`` by key order are kept; keys are cut to
    ``key_len`` and values to ``value_len`` characters. Keys that become
    equal after the cut collapse to one entry (the later one in key order
    wins) but both counted towards the limit. An empty result is null, the
    same as an omitted ``properties`` object.
    """
    p = F.col(props) if isinstance(props, str) else props
    # ``sort_array`` compares natively (``array_sort`` runs a comparator lambda
    # per pair), and keys differ, so values are never compared.
    kept = F.slice(F.sort_array(F.map_entries(F.map_filter(p, lambda k, v: v != F.lit("")))), 1, max_entries)
    cut = F.transform(kept, lambda e: F.named_struct(F.lit("key"), F.left(e["key"], F.lit(key_len)),
                                                     F.lit("value"), F.left(e["value"], F.lit(value_len))))
    # Keep the last of equal cut keys (they are adjacent in key order): one
    # left fold that replaces the tail entry when the key repeats. The fold
    # touches only its accumulator, so nothing is re-evaluated per element.
    empty = F.array().cast("array<struct<key:string,value:string>>")

    def step(acc, e):
        same = (F.size(acc) > 0) & (F.element_at(acc, -1)["key"] == e["key"])
        return F.when(same, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(e))) \
                .otherwise(F.concat(acc, F.array(e)))

    deduped = F.aggregate(cut, empty, step)
    # Named once: a condition beside the value would clean the map twice.
    return F.get(F.filter(F.array(F.map_from_entries(deduped)), lambda m: F.size(m) > 0), F.lit(0))
