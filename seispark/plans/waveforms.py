"""The waveform job: pairs in, windows, misfits and adjoint sources out."""

from pyspark.sql import functions as F

from seispark.functions.columns import required
from seispark.functions.geo import with_geodesic_km
from seispark.operators import traces, windows
from seispark.operators.chunks import attach, only_traces, with_chunk
from seispark.operators.misfit import adjoint_sources, weighted_misfits
from seispark.operators.spatial import station_weights
from seispark.session import materialise


def write_adjoint_sources(adjoint, weights, path):
    """Rows (event, station, i, z, n, e): components side by side, absent ones 0, times the station's weight."""
    keys = [c for c in ("event", "station") if c in weights.columns]
    series = with_chunk(adjoint.withColumn("trace", F.struct("event", "station")))
    lengths = series.groupBy("trace").agg((F.max("i") + 1).alias("n"))
    weighted = lengths.withColumns({k: F.col(f"trace.{k}") for k in keys}).join(weights.select(*keys, "weight"), keys, "left").drop(*keys)
    wide = (
        attach(series, weighted.withColumn("weight", required("weight", "the weight of a station")))
        .withColumn("a", F.col("a") * F.col("weight"))
        .groupBy("event", "station", "i")
        .pivot("component", ["Z", "N", "E"])
        .agg(F.first("a"))
        .fillna(0.0, ["Z", "N", "E"])
    )
    wide.select(
        "event", F.translate("station", ".", "_").alias("station"), "i", F.col("Z").alias("z"), F.col("N").alias("n"), F.col("E").alias("e")
    ).write.mode("overwrite").partitionBy("event").parquet(path)


def write_misfits(misfits, weights, path):
    """Rows (event, station, map of channel to weighted misfit)."""
    weighted = weighted_misfits(misfits, weights)
    weighted.groupBy("event", "station").agg(
        F.map_from_entries(F.collect_list(F.struct("channel", "misfit"))).alias("misfits")
    ).write.mode("overwrite").partitionBy("event").parquet(path)


def station_distances(stations, origins):
    """(event, station, dist_km) on the ellipsoid; both tables have lat and lon."""
    places = stations.join(origins.select("event", F.col("lat").alias("elat"), F.col("lon").alias("elon")), "event")
    return with_geodesic_km(places, "elat", "elon", "lat", "lon").select("event", "station", "dist_km")


def process_events(pair, distances, weights, settings, kind="ccc", scale=True, pulse=0, global_mode=False, scaled=False):
    """Windows, weighted misfits and adjoint sources of all traces.

    ``pair`` is (trace, chunk, i, d, s); ``weights`` (trace, weight), or None for none. Returns
    (windows, misfits, adjoint). The windows are a written table: the second
    half works on traces with windows only, and a run without any window fails, as does a trace without a weight.
    """
    if scale:
        pair = traces.scale_to_synthetic(pair, traces.trace_stats(pair))
    pair = materialise(pair, "pair")
    found = windows.select_windows(pair, distances, settings, pulse, global_mode)
    by_start = found.withColumn("win", F.col("start"))
    by_start = materialise(by_start, "windows")
    if by_start.isEmpty():
        raise ValueError("no window was found in any trace")
    some = only_traces(pair, by_start)
    misfits, adjoint = adjoint_sources(kind, some, by_start, settings.min_period, settings.max_period, settings.dt, scaled)
    if weights is None:
        return by_start, misfits, adjoint
    weight = required("weight", "the weight of a trace")
    misfits = misfits.join(weights, "trace", "left").withColumn("misfit", F.col("misfit") * weight)
    weighted = traces.lengths(pair).join(weights, "trace", "left").withColumn("weight", weight)
    adjoint = attach(adjoint, weighted).withColumn("a", F.col("a") * F.col("weight")).drop("weight", "n")
    return by_start, misfits, adjoint


def preprocess_job(headers, samples, orientation, origins, path, tag, dt, npts, min_period, max_period, start_time=0.0, raw="raw_recording"):
    """Raw traces of all events to filtered ones on one time grid, written with ``tag``; returns the table.

    ``headers`` (event, station, channel, tag, t0, dt) and ``samples`` (event, station, channel, tag, i, v); ``orientation``
    (event, station, channel, azimuth, dip); ``origins`` (event, time). Only traces with the tag ``raw`` are taken. Each is cut
    to the wanted span and a fifth of it on either side, decimated, detrended and tapered; stations with three channels of which
    one is BH1 or BH2 are rotated to Z, N and E; then two band-passes and a resampling to ``npts`` samples from ``start_time``
    after the origin. Traces of one sampling interval go through together. The table is written as a whole or not at all:
    without its success marker it is not there.
    """
    keys = ["event", "station", "channel"]
    name = F.struct(*keys).alias("trace")
    start = origins.select("event", (F.col("time") + start_time).alias("lo"), (F.col("time") + start_time + (npts - 1) * dt).alias("hi"))
    known = headers.where(F.col("tag") == raw).join(start, "event").select(name, "t0", "dt", "lo", "hi")
    known = materialise(known, "raw-headers")
    rows = samples.where(F.col("tag") == raw).select(name, "i", "v")
    out = None
    for (interval,) in known.select("dt").distinct().orderBy("dt").collect():
        own = known.where(F.col("dt") == interval)
        cut, starts = traces.trim_in_time(with_chunk(rows.join(own.select("trace"), "trace", "left_semi")), own)
        cut, new = traces.decimate(cut, interval, dt)
        flat = materialise(traces.detrend_taper(cut), "flat")
        flat, starts = rotated(flat, starts, orientation)
        filtered = traces.double_bandpass(flat, min_period, max_period, new)
        begin = starts.join(start, F.col("trace.event") == F.col("event")).select("trace", ((F.col("lo") - F.col("t0")) / new).alias("first"))
        done = traces.to_float32(traces.lanczos(filtered, dt / new, 12, points=str(npts), starts=begin)).select("trace.*", "i", "v")
        out = done if out is None else out.unionByName(done)
    if out is None:
        raise ValueError(f"no trace has the tag {raw}")
    out.withColumn("tag", F.lit(tag)).write.mode("overwrite").partitionBy("event").parquet(path)
    return headers.sparkSession.read.parquet(path)


def rotated(samples, starts, orientation):
    """Samples and starts with the stations rotated that have three channels, one of them BH1 or BH2."""
    place = F.struct("trace.event", "trace.station")
    turning = (
        starts.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.max(F.col("trace.channel").isin("BH1", "BH2")).alias("odd"))
        .where("n = 3 and odd").select("place")
    )
    other = starts.join(turning, place == F.col("place"), "left_anti").select("trace")
    stay = only_traces(samples, other)
    turn = samples.withColumn("place", place).join(turning, "place", "left_semi")
    axes = orientation.select(F.struct("event", "station").alias("trace"), "channel", "azimuth", "dip")
    mixed = traces.rotate_to_zne(turn.select(F.col("place").alias("trace"), F.col("trace.channel").alias("channel"), "i", "v"), axes)
    channel = F.concat(F.lit("BH"), "component").alias("channel")
    moved = mixed.select(F.struct("trace.event", "trace.station", channel).alias("trace"), "i", "v")
    new = starts.join(turning, place == F.col("place"), "left_semi").groupBy("trace.event", "trace.station").agg(F.min("t0").alias("t0"))
    letters = F.explode(F.array(*[F.lit(f"BH{c}") for c in "ZNE"])).alias("channel")
    new = new.select("event", "station", "t0", letters).select(F.struct("event", "station", "channel").alias("trace"), "t0")
    return with_chunk(stay.select("trace", "i", "v").unionByName(moved)), starts.join(other, "trace", "left_semi").unionByName(new)


def chosen_traces(headers):
    """(event, station, channel, tag, component, ...) of stations with one tag, and of its components that only one channel has."""
    keys = ["event", "station"]
    one = traces.one_tag_only(headers, keys)
    single = traces.select_component(headers, by=keys).where(F.col("component").isin("Z", "N", "E"))
    return headers.join(one, [*keys, "tag"]).join(single, [*keys, "channel"])


def event_job(observed, synthetic, stations, origins, settings, path, start_time=0.0, kind="ccc", pulses=None, **options):
    """All events from two sets of traces to written adjoint sources and misfits; returns the windows.

    ``observed`` and ``synthetic`` are (headers, samples): headers (event, station, channel, tag, t0, dt), samples
    (event, station, channel, tag, i, v). ``stations`` (event, station, lat, lon) and ``origins`` (event, time, lat,
    lon). Stations need one tag and components one channel; a synthetic starts ``start_time`` seconds after its origin
    whatever its header says, and is brought to the rate of the data. The travel-time bound follows the width of
    each event's source pulse: its samples (event, i, v) in ``pulses``, or the band-limited step of the traces' length.
    Distances run on the ellipsoid; weights are those of the event's stations. Results are in path/adjoint and path/misfits.
    """
    keys, settings_dt = ["event", "station", "component"], settings.dt
    d, s = chosen_traces(observed[0]), chosen_traces(synthetic[0])
    start = origins.select("event", (F.col("time") + start_time).alias("t0_s"))
    headers = traces.pair_traces(
        d.select(*keys, F.col("t0").alias("t0_d"), F.col("dt").alias("dt_d")), s.select(*keys, F.col("dt").alias("dt_s")), keys
    ).join(start, "event")
    name = F.struct(*keys).alias("trace")
    headers = materialise(headers.select(name, "t0_d", "dt_d", "t0_s", "dt_s"), "headers")

    def samples(chosen, rows):
        own = chosen.select("event", "station", "channel", "tag", "component").join(headers.select("trace.*"), keys, "left_semi")
        return with_chunk(rows.join(own, ["event", "station", "channel", "tag"]).select(name, "i", "v"))

    pair = materialise(traces.align_in_time(samples(d, observed[1]), samples(s, synthetic[1]), headers), "aligned")
    if pulses is None:
        per_event = traces.lengths(pair).groupBy(F.col("trace.event").alias("trace")).agg(F.max("n").alias("n"))
        pulses = materialise(traces.source_pulse(per_event, settings.min_period, settings.max_period, settings_dt), "pulses")
    else:
        pulses = with_chunk(pulses.withColumnRenamed("event", "trace"))
    widths = windows.pulse_width(pulses).select(F.col("trace").alias("event"), "pulse")
    places = station_distances(stations, origins).join(widths, "event", "left")
    distances = headers.select("trace", "trace.event", "trace.station").join(places, ["event", "station"], "left")
    found, misfits, adjoint = process_events(
        pair, distances.select("trace", "dist_km", "pulse"), None, settings, kind, pulse=required("pulse", "the pulse of an event"), **options
    )
    weights = materialise(station_weights(stations), "station-weights")
    write_adjoint_sources(adjoint.select("trace.*", "i", "a"), weights, f"{path}/adjoint")
    write_misfits(misfits.select("trace.event", "trace.station", F.col("trace.component").alias("channel"), "misfit"), weights, f"{path}/misfits")
    return found
