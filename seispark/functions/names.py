"""Names and keys as Column expressions."""

from pyspark.sql import functions as F


def iteration_name(n):
    return F.format_string("model_%05d", n)


def iteration_number(name):
    return F.element_at(F.split(name, "_"), -1).cast("int")


def strip_iteration_prefix(name):
    return F.regexp_replace(name, "^ITERATION_", "")


def processed_key(min_period, max_period):
    return F.format_string("preprocessed_%ds_to_%ds", min_period, max_period)


def split_trace_id(trace_id):
    """network, station, channel of net.sta.cha; what follows the second dot is the channel."""
    parts = F.split(trace_id, "[.]", 3)
    return {"network": parts[0], "station": parts[1], "channel": parts[2]}


def flat_station(station):
    return F.translate(station, ".", "_")
