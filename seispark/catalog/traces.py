"""Queries over traces: selection, alignment, signal steps, correlations."""

from pyspark.sql import functions as F

from seispark.catalog.views import over, query
from seispark.functions import kernels, sampled
from seispark.functions.columns import rnd
from seispark.operators import chunks, correlate, traces
from seispark.plans.waveforms import write_adjoint_sources, write_misfits
from seispark.session import materialise
from seispark.sources import stores, tables
from seispark.operators.misfit import weighted_misfits

# ---- reading --------------------------------------------------------------


@query("scan_traces", over("b_samples", """select trace % 10 as event, trace as station, 'raw_recording' as tag, cast(count(*) as int) as npts,
  round(sum(v), 2) as total from b_samples group by trace"""))
def scan_traces(spark, folder):
    path = stores.new_store(spark, "traces")
    s = tables.samples(spark, folder).selectExpr("trace % 10 as event", "trace as station", "'raw_recording' as tag", "chunk", "i", "v")
    stores.write_traces(s, path)
    read = stores.read_traces(spark, path, tag="raw_recording")
    return read.groupBy(F.col("event").cast("bigint").alias("event"), "station", "tag").agg(
        F.sum(F.size("samples")).cast("int").alias("npts"),
        rnd(F.sum(F.aggregate("samples", F.lit(0.0), lambda a, x: a + x)), 2).alias("total"),
    )


@query("scan_catalog", """select user_id as event, event_id as origin, epoch_us(ts) as time_us from events
  qualify row_number() over (partition by user_id order by case when event_type = 'purchase' then 0 else 1 end, event_id) = 1""")
def scan_catalog(spark, folder):
    origins = tables.table(spark, folder, "events").selectExpr(
        "user_id as event", "event_id as origin", "event_type = 'purchase' as preferred", "unix_micros(cast(ts as timestamp)) as time_us"
    )
    return stores.preferred_origin(origins).select("event", "origin", "time_us")


HEADERS = ", h as (select distinct user_id * 100 + cast(floor(value/40) as bigint) as station, {c} as {n} from events)"
CHANNEL = "case event_type when 'click' then 'BHZ' when 'signup' then 'bhz' when 'view' then 'BHN' when 'error' then 'BHE' else 'BH1' end"


def _headers(spark, folder, column, name):
    return tables.table(spark, folder, "events").selectExpr(
        "user_id * 100 + cast(floor(value/40) as bigint) as station", f"{column} as {name}"
    ).distinct()


@query("select_component", "with dummy as (select 1)" + HEADERS.format(c=CHANNEL, n="channel") + """
select station, upper(right(channel, 1)) as component, min(channel) as channel from h group by 1, 2 having count(*) = 1""")
def select_component(spark, folder):
    return traces.select_component(_headers(spark, folder, CHANNEL, "channel")).select("station", "component", "channel")


@query("one_tag_only", "with dummy as (select 1)" + HEADERS.format(c="event_type", n="tag") + """
select station, min(tag) as tag from h group by station having count(distinct tag) = 1""")
def one_tag_only(spark, folder):
    return traces.one_tag_only(_headers(spark, folder, "event_type", "tag"))


@query("reject_bad_traces", over("b_samples", """, x as (select trace, case when v > 300 then 'nan'::double when trace % 7 = 0 then 0.0e0 else v end as v from b_samples)
select trace, not bool_or(isnan(v)) and max(abs(v)) > 0 as usable from x group by trace"""))
def reject_bad_traces(spark, folder):
    x = tables.samples(spark, folder).withColumn("v", F.expr("case when v > 300 then double('NaN') when trace % 7 = 0 then 0.0e0 else v end"))
    return traces.usable(x)


# ---- pairs ----------------------------------------------------------------

KEYS = "trace % 10 as event, trace as station, case trace % 3 when 0 then 'E' when 1 then 'N' else 'Z' end as component"
TRACE_N = ", tn as (select trace, count(*) as n from b_samples group by trace)"


@query("pair_obs_syn", over("b_pair", TRACE_N + f"""select event, station, component, cast(n as bigint) as n from (select {KEYS}, n from tn) where n >= 60"""))
def pair_obs_syn(spark, folder):
    n = traces.lengths(tables.samples(spark, folder))
    observed = n.selectExpr(*KEYS.split(", ", 2), "n")
    synthetic = n.where("n >= 60").selectExpr(*KEYS.split(", ", 2), "n as n_syn")
    return traces.pair_traces(observed, synthetic, ["event", "station", "component"]).select("event", "station", "component", "n")


# The synthetic is sampled every 0.75 s from the origin, the data every second from one or two seconds later.
RESAMPLED = """, sp as (select trace, i, s as y, lead(s) over w as y1, s - lag(s) over w as a, lead(s) over w - s as b, lead(s, 2) over w - lead(s) over w as c
  from b_pair window w as (partition by trace order by i)),
sl as (select trace, i, y, y1, case when a is null then b when b is null then a when sign(a) = sign(b) then
    (a/greatest(abs(a), power(2.0e0, -52)) + b/greatest(abs(b), power(2.0e0, -52)))/(1/greatest(abs(a), power(2.0e0, -52)) + 1/greatest(abs(b), power(2.0e0, -52))) else 0 end as m,
  case when b is null then c when c is null then b when sign(b) = sign(c) then
    (b/greatest(abs(b), power(2.0e0, -52)) + c/greatest(abs(c), power(2.0e0, -52)))/(1/greatest(abs(b), power(2.0e0, -52)) + 1/greatest(abs(c), power(2.0e0, -52))) else 0 end as n from sp),
ln as (select trace, count(*) as n from b_pair group by trace),
gr as (select trace, j, j*4.0e0/3 as x from (select trace, unnest(range(cast(floor((n - 1)*3/4.0e0) as bigint) + 1)) as j, n from ln)),
rs as (select gr.trace, j, x - sl.i as u, y, y1, m, sl.n from gr join sl on sl.trace = gr.trace and sl.i = cast(floor(x + 1e-12) as bigint)),
sy as (select trace, j, case when y1 is null then y else (1+2*u)*(1-u)*(1-u)*y + u*(1-u)*(1-u)*m + u*u*(3-2*u)*y1 + u*u*(u-1)*n end as s from rs),
al as (select p.trace, p.i, p.d, sy.s from b_pair p join sy on sy.trace = p.trace and sy.j = p.i + 1 + p.trace % 2)
"""


@query("align_pair", over("b_pair", RESAMPLED + "select trace, i, round(d, 6) as d, round(s, 6) + 0.0e0 as s from al"))
def align_pair(spark, folder):
    p = materialise(tables.pair(spark, folder), "pair")
    headers = p.select("trace").distinct().selectExpr("trace", "101.0e0 + trace % 2 as t0_d", "1.0e0 as dt_d", "100.0e0 as t0_s", "0.75e0 as dt_s")
    both = traces.align_in_time(p.selectExpr("trace", "chunk", "i", "d as v"), p.selectExpr("trace", "chunk", "i", "s as v"), headers)
    return both.select("trace", "i", rnd("d", 6).alias("d"), rnd("s", 6).alias("s"))


@query("pair_sanity", over("b_pair", """, st as (select trace, count(*) as n, max(d)-min(d) as pd, max(s)-min(s) as ps from b_pair group by trace),
c as (select trace, (trace % 5 = 0) as bad_n, (trace % 4 = 0) as bad_rate, (trace % 3 = 0) as bad_start,
  greatest(pd, ps)/least(pd, ps) >= 5 as amp, (trace % 2 = 0) as comp from st)
select trace, concat_ws(',', case when bad_n then 'npts' end, case when bad_rate then 'rate' end, case when bad_start then 'start' end) as errors,
  concat_ws(',', case when amp then 'amplitude' end, case when comp then 'component' end) as warnings from c"""))
def pair_sanity(spark, folder):
    st = traces.trace_stats(tables.pair(spark, folder))
    pairs = st.selectExpr(
        "trace", "n as n_d", "n + if(trace % 5 = 0, 1, 0) as n_s", "1.0e0 as dt_d", "1.0e0 + if(trace % 4 = 0, 1.0e-3, 1.0e-7) as dt_s",
        "0.0e0 as t0_d", "if(trace % 3 = 0, 0.6e0, 0.4e0) as t0_s", "ptp_d", "ptp_s", "'BHZ' as cha_d", "if(trace % 2 = 0, 'BHN', 'LHz') as cha_s",
    )
    return traces.pair_checks(pairs).select("trace", F.concat_ws(",", "errors").alias("errors"), F.concat_ws(",", "warnings").alias("warnings"))


@query("trace_stats", over("b_pair", """select trace, count(*) as n, round(max(d)-min(d), 6) as ptp_d, round(max(s)-min(s), 6) as ptp_s, round(max(abs(d)), 6) as max_d,
  round(sum(d*d), 7) as energy_d, round(sum(s*s), 7) as energy_s, round(sum(d*s)/(sqrt(sum(d*d))*sqrt(sum(s*s))), 9) as cc from b_pair group by trace"""))
def trace_stats(spark, folder):
    st = traces.trace_stats(tables.pair(spark, folder))
    return st.select(
        "trace", "n", rnd("ptp_d", 6).alias("ptp_d"), rnd("ptp_s", 6).alias("ptp_s"), rnd("max_d", 6).alias("max_d"),
        rnd("dd", 7).alias("energy_d"), rnd("ss", 7).alias("energy_s"), rnd("cc", 9).alias("cc"),
    )


@query("scale_to_synthetic", over("b_pair", """, st as (select trace, (max(s)-min(s))/(max(d)-min(d)) as f from b_pair group by trace)
select p.trace, i, round(d*f, 10) as d from b_pair p join st on p.trace = st.trace"""))
def scale_to_synthetic(spark, folder):
    p = tables.pair(spark, folder)
    return traces.scale_to_synthetic(p, traces.trace_stats(p)).select("trace", "i", rnd("d", 10).alias("d"))


@query("nearest_index", over("b_samples", """, r as (select trace, i, row_number() over (partition by trace order by i) - 1 as pos from b_samples where v > 60),
m as (select s.trace, s.i, r.pos, row_number() over (partition by s.trace, s.i order by abs(s.i - r.i), r.i desc) as rn
  from b_samples s join r on s.trace = r.trace)
select trace, i, cast(pos as bigint) as match from m where rn = 1"""))
def nearest_index(spark, folder):
    s = tables.samples(spark, folder)
    return chunks.nearest(s.where("v > 60").select("trace", "i"), s.select("trace", "i")).select("trace", "i", "match")


WINDOWS_SQL = """, w as (select trace, 0 as win, cast(trace % 7 as bigint) as start, cast(count(*) - 5 as bigint) as stop from b_pair group by trace
  union all select distinct trace, 1, 10, 30 from b_pair)"""


def two_windows(pair):
    """Two overlapping windows per trace."""
    n = traces.lengths(pair)
    long = n.selectExpr("trace", "0 as win", "cast(trace % 7 as bigint) as start", "n - 5 as stop")
    return long.unionByName(n.selectExpr("trace", "1 as win", "10L as start", "30L as stop"))


@query("windows_to_samples", over("b_pair", WINDOWS_SQL + "select p.trace, win, i, d from b_pair p join w on p.trace = w.trace and i between start and stop"))
def windows_to_samples(spark, folder):
    p = tables.pair(spark, folder)
    spans = two_windows(p).withColumn("end", F.col("stop") + 1)
    return chunks.in_ranges(p, spans, stop="end").select("trace", "win", "i", "d")


@query("apply_station_weight", over("b_pair b_stations", """, w as (select s_suppkey as station, 1.0e0 + (s_suppkey % 10) / 10.0e0 as weight from supplier)
select p.trace as station, round(sum(abs(d - s)) * any_value(weight), 5) as misfit from b_pair p join w on p.trace = w.station group by p.trace"""))
def apply_station_weight(spark, folder):
    m = tables.pair(spark, folder).groupBy(F.col("trace").alias("station")).agg(F.sum(F.abs(F.col("d") - F.col("s"))).alias("misfit"))
    w = tables.stations(spark, folder).selectExpr("station", "1.0e0 + (station % 10) / 10.0e0 as weight")
    return weighted_misfits(m.join(w, "station", "left_semi"), w).select("station", rnd("misfit", 5).alias("misfit"))


@query("source_receiver_min_distance", over("b_stations b_sources", """select station, 2*p*2.4e0 as min_km, p as min_period from b_stations,
  (select unnest([10.0e0, 20.0e0, 50.0e0]) as p)"""))
def source_receiver_min_distance(spark, folder):
    s = tables.stations(spark, folder).withColumn("min_period", F.explode(F.array(F.lit(10.0), F.lit(20.0), F.lit(50.0))))
    return s.select("station", (2 * F.col("min_period") * 2.4).alias("min_km"), "min_period")


# ---- simple signal steps --------------------------------------------------


@query("trim_pad", over("b_samples", """, g as (select trace, cast(unnest(range(-5, 60)) as bigint) as i from (select distinct trace from b_samples))
select g.trace, g.i + 5 as i, coalesce(v, 0.0e0) as v from g left join b_samples s on s.trace = g.trace and s.i = g.i"""))
def trim_pad(spark, folder):
    return traces.trim_pad(tables.samples(spark, folder), -5, 60).select("trace", "i", "v")


LINE = ", ln as (select trace, count(*) as n, regr_slope(v, i) as b, regr_intercept(v, i) as a from {t} group by trace)"
TAPER = """case when least({i}, {n}-1-{i}) < floor({r}*{n}) then 0.5e0*(1-cos(pi()*least({i}, {n}-1-{i})/floor({r}*{n}))) else 1.0e0 end"""


@query("detrend", over("b_samples", LINE.format(t="b_samples") + "select s.trace, i, round(v - a - b*i, 8) + 0.0e0 as v from b_samples s join ln on s.trace = ln.trace"))
def detrend(spark, folder):
    return traces.detrend(tables.samples(spark, folder)).select("trace", "i", rnd("v", 8).alias("v"))


@query("taper", over("b_samples", TRACE_N + f"select s.trace, i, round(v * {TAPER.format(i='i', n='n', r='0.05e0')}, 7) + 0.0e0 as v from b_samples s join tn on s.trace = tn.trace"))
def taper(spark, folder):
    return traces.taper(tables.samples(spark, folder)).select("trace", "i", rnd("v", 7).alias("v"))


@query("to_float32", over("b_samples", "select trace, i, cast(v as float) as v from b_samples"))
def to_float32(spark, folder):
    return traces.to_float32(tables.samples(spark, folder)).select("trace", "i", "v")


@query("rotate_to_zne", over("b_samples", """, x as (select trace, i, v as b1, 2*v + i as b2, v - 3 as bz, radians(trace % 90) as az from b_samples)
select trace, i, round(bz, 6) + 0.0e0 as z, round(b1*cos(az) - b2*sin(az), 6) + 0.0e0 as n, round(b1*sin(az) + b2*cos(az), 6) + 0.0e0 as e from x"""))
def rotate_to_zne(spark, folder):
    s = tables.samples(spark, folder).selectExpr("trace", "i", "stack(3, 'BH1', v, 'BH2', 2*v + i, 'BHZ', v - 3) as (channel, v)")
    o = s.select("trace").distinct().selectExpr(
        "trace", "stack(3, 'BH1', double(trace % 90), 0.0e0, 'BH2', double(trace % 90 + 90), 0.0e0, 'BHZ', 0.0e0, -90.0e0) as (channel, azimuth, dip)"
    )
    wide = traces.rotate_to_zne(s, o).groupBy("trace", "i").pivot("component", ["Z", "N", "E"]).agg(F.first("v"))
    return wide.select("trace", "i", rnd("Z", 6).alias("z"), rnd("N", 6).alias("n"), rnd("E", 6).alias("e"))


def _lanczos_sql(ratio, a, source="b_samples", v="v"):
    x = f"(j.j*{ratio!r}e0 - s.i)"
    return f""", jj as (select trace, cast(unnest(range(cast(floor((count(*)-1)/{ratio!r}e0) as bigint) + 1)) as bigint) as j from {source} group by trace),
  lz as (select j.trace, j.j as i, sum({v} * case when {x} = 0 then 1.0e0 else sin(pi()*{x})/(pi()*{x}) end
    * (0.42e0 + 0.5e0*cos(pi()*{x}/{a}) + 0.08e0*cos(2*pi()*{x}/{a}))) as v
    from jj j join {source} s on s.trace = j.trace and abs({x}) < {a} group by j.trace, j.j)"""


@query("lanczos_resample", over("b_samples", _lanczos_sql(0.75, 12) + "select trace, i, round(v, 6) + 0.0e0 as v from lz"))
def lanczos_resample(spark, folder):
    return traces.lanczos(tables.samples(spark, folder), 0.75, 12).select("trace", "i", rnd("v", 6).alias("v"))


# ---- recursive filters ----------------------------------------------------


def filter_sql(name, source, sections, backward=False):
    """Recursive CTE that steps all traces at once through the second-order sections."""
    last = len(sections)
    zeros = ", ".join(f"0.0e0 as p{k}, 0.0e0 as q{k}" for k in range(last))
    out, states = "", []
    for k, section in enumerate(sections):
        b0, b1, b2, a1, a2 = (repr(float(x)) + "::double" for x in section)
        out += f", {b0}*({'x' if k == 0 else f'y{k - 1}'}) + op{k} as y{k}"
        src = "x" if k == 0 else f"y{k - 1}"
        states.append(f"{b1}*{src} - {a1}*y{k} + oq{k} as np{k}, {b2}*{src} - {a2}*y{k} as nq{k}")
    old = ", ".join(f"f.p{k} as op{k}, f.q{k} as oq{k}" for k in range(last))
    carry = ", ".join(f"np{k} as p{k}, nq{k} as q{k}" for k in range(last))
    return f""", {name}_in as (select trace, i, v, max(i) over (partition by trace) as li from {source}),
{name}_o as (select trace, {'cast(li - i as bigint)' if backward else 'i'} as i, v from {name}_in),
{name}_r as (select trace, cast(-1 as bigint) as i, 0.0e0 as v, {zeros} from (select distinct trace from {source}) union all
  select trace, i, y{last - 1} as v, {carry} from (select *, {", ".join(states)} from (select *{out} from (
    select s.trace, s.i, s.v as x, {old} from {name}_r f join {name}_o s on s.trace = f.trace and s.i = f.i + 1)))),
{name} as (select r.trace, {'cast(n.li - r.i as bigint)' if backward else 'r.i'} as i, r.v from {name}_r r
  join (select distinct trace, li from {name}_in) n on n.trace = r.trace where r.i >= 0)"""


def detrend_taper_sql(name, source):
    return f""", {name}_l as (select trace, count(*) as n, regr_slope(v, i) as b, regr_intercept(v, i) as a from {source} group by trace),
{name} as (select s.trace, s.i, (v - a - b*s.i) * {TAPER.format(i='s.i', n='n', r='0.05e0')} as v from {source} s join {name}_l l on l.trace = s.trace)"""


def double_bandpass_sql(source, sections):
    return (
        detrend_taper_sql("dt1", source) + filter_sql("bp1", "dt1", sections)
        + detrend_taper_sql("dt2", "bp1") + filter_sql("bp2", "dt2", sections)
    )


BAND = (4.0, 20.0)
BAND_SECTIONS = kernels.bandpass_sections(1 / BAND[1], 1 / BAND[0], 1.0)


@query("bandpass", over("b_samples", double_bandpass_sql("b_samples", BAND_SECTIONS) + "select trace, i, round(v, 6) + 0.0e0 as v from bp2", True))
def bandpass(spark, folder):
    return traces.double_bandpass(tables.samples(spark, folder), *BAND).select("trace", "i", rnd("v", 6).alias("v"))


LOW = kernels.lowpass_sections(0.25, 1.0)
DECIMATE = filter_sql("lf", "b_samples", LOW) + filter_sql("lb", "lf", LOW, True) + ", dec as (select trace, cast(i // 2 as bigint) as i, v from lb where i % 2 = 0)"


@query("decimate", over("b_samples", DECIMATE + "select trace, i, round(v, 5) + 0.0e0 as v from dec", True))
def decimate(spark, folder):
    return traces.decimate(tables.samples(spark, folder), 1.0, 2.0)[0].select("trace", "i", rnd("v", 5).alias("v"))


HALF_SECTIONS = kernels.bandpass_sections(1 / 40.0, 1 / 8.0, 0.5)
PREPROCESS = (
    DECIMATE + detrend_taper_sql("dt0", "dec") + double_bandpass_sql("dt0", HALF_SECTIONS)
    + _lanczos_sql(1.25, 12, "bp2")
)


@query("preprocess_traces", over("b_samples", PREPROCESS + "select trace, i, round(cast(cast(v as float) as double), 4) + 0.0e0 as v from lz", True))
def preprocess_traces(spark, folder):
    out = traces.preprocess(tables.samples(spark, folder), 1.0, 2.5, 8.0, 40.0)
    return out.select("trace", "i", rnd(F.col("v").cast("double"), 4).alias("v"))


@query("source_time_function", over("b_samples", TRACE_N + """, step as (select trace, cast(i as bigint) as i, case when i < n then 0.0e0 else 1.0e0 end as v
  from (select trace, n, unnest(range(2*n)) as i from tn))""" + double_bandpass_sql("step", BAND_SECTIONS) + """
select b.trace, cast(b.i - tn.n as bigint) as i, case when b.i = tn.n then 0.0e0 else round(v, 8) + 0.0e0 end as v from bp2 b join tn on tn.trace = b.trace where b.i >= tn.n""", True))
def source_time_function(spark, folder):
    n = traces.lengths(tables.samples(spark, folder))
    return traces.source_pulse(n, *BAND).select("trace", "i", rnd("v", 8).alias("v"))


# ---- envelope and correlation ---------------------------------------------

def hilbert_sql(name, source, v="v"):
    """CTE {name}(trace, i, h): discrete Hilbert transform of column v."""
    return f""", {name}_n as (select trace, count(*) as n from {source} group by trace),
{name} as (select a.trace, a.i, sum(b.{v} * case when a.i = b.i then 0.0e0
   when n % 2 = 0 then case when (a.i - b.i) % 2 = 0 then 0.0e0 else 2.0e0/n/tan(pi()*(a.i - b.i)/n) end
   else (1.0e0/tan(pi()*(a.i - b.i)/n) - (case when (a.i - b.i) % 2 = 0 then 1.0e0 else -1.0e0 end)/sin(pi()*(a.i - b.i)/n))/n end) as h
  from {source} a join {source} b on a.trace = b.trace join {name}_n c on c.trace = a.trace group by a.trace, a.i)"""


@query("envelope", over("b_samples", hilbert_sql("hb", "b_samples") + """select s.trace, s.i, round(sqrt(v*v + h*h), 6) as envelope
  from b_samples s join hb on hb.trace = s.trace and hb.i = s.i"""))
def envelope(spark, folder):
    return traces.envelope(tables.samples(spark, folder)).select("trace", "i", rnd("env_v", 6).alias("envelope"))


@query("cross_correlation", over("b_pair", """, c as (select a.trace, cast(a.i - b.i as bigint) as lag, sum(a.d*b.s) as c from b_pair a join b_pair b on a.trace = b.trace group by 1, 2),
n as (select trace, 2*count(*) - 1 as m from b_pair group by trace)
select c.trace, cast(((lag % m) + m) % m as bigint) as position, lag, round(c, 6) as c from c join n on n.trace = c.trace"""))
def cross_correlation(spark, folder):
    return correlate.cross_correlation(tables.pair(spark, folder)).select("trace", "position", "lag", rnd("c", 6).alias("c"))


@query("best_shift", over("b_pair", """, c as (select a.trace, cast(a.i - b.i as bigint) as lag, sum(a.s*b.d) as c from b_pair a join b_pair b on a.trace = b.trace
  and a.i - b.i between -4 and 4 group by 1, 2)
select trace, lag, round(c, 6) as c from c qualify row_number() over (partition by trace order by c desc, lag) = 1"""))
def best_shift(spark, folder):
    return correlate.best_shift(tables.pair(spark, folder), 4).select("trace", "lag", rnd("c", 6).alias("c"))


#: Chunk of the queries over long traces, so that the grids of their transforms have many rows and columns.
SHORT = 64


@query("envelope_long", over("b_long", hilbert_sql("hb", "b_long") + """select s.trace, s.i, round(sqrt(v*v + h*h), 6) as envelope
  from b_long s join hb on hb.trace = s.trace and hb.i = s.i"""))
def envelope_long(spark, folder):
    return traces.envelope(tables.long_samples(spark, folder, SHORT), size=SHORT).select("trace", "i", rnd("env_v", 6).alias("envelope"))


@query("cross_correlation_long", over("b_long_pair", """, c as (select a.trace, cast(a.i - b.i as bigint) as lag, sum(a.d*b.s) as c from b_long_pair a join b_long_pair b on a.trace = b.trace group by 1, 2),
n as (select trace, 2*count(*) - 1 as m, sqrt(sum(d*d))*sqrt(sum(s*s)) as e from b_long_pair group by trace)
select c.trace, cast(((lag % m) + m) % m as bigint) as position, lag, round(c/e, 9) as c from c join n on n.trace = c.trace"""))
def cross_correlation_long(spark, folder):
    pair = tables.long_pair(spark, folder, SHORT)
    energy = traces.trace_stats(pair).select("trace", (F.sqrt("dd") * F.sqrt("ss")).alias("e"))
    return correlate.cross_correlation(pair, size=SHORT).join(energy, "trace").select("trace", "position", "lag", rnd(F.col("c") / F.col("e"), 9).alias("c"))


@query("best_shift_long", over("b_long_pair", """, c as (select a.trace, cast(a.i - b.i as bigint) as lag, sum(a.s*b.d) as c from b_long_pair a join b_long_pair b on a.trace = b.trace
  and a.i - b.i between -90 and 90 group by 1, 2)
select trace, lag, round(c, 4) as c from c qualify row_number() over (partition by trace order by c desc, lag) = 1"""))
def best_shift_long(spark, folder):
    return correlate.best_shift(tables.long_pair(spark, folder, SHORT), 90, SHORT).select("trace", "lag", rnd("c", 4).alias("c"))


@query("gaussian_window", over("b_samples", "select trace, i, round(power(pi()*64.0e0, -0.25e0)*exp(-0.5e0*(i-30)*(i-30)/64.0e0), 12) as w from b_samples"))
def gaussian_window(spark, folder):
    w = sampled.gaussian_window(F.col("i") - 30, 8.0)
    return tables.samples(spark, folder).select("trace", "i", rnd(w, 12).alias("w"))


@query("matlab_range", over("b_samples", TRACE_N + """, r as (select trace, 0.5e0*trace as start, 0.5e0*trace + n/4.0e0 as stop, 0.25e0*(1 + trace % 3) as step from tn),
k as (select *, (stop-start)/step as q from r),
e as (select trace, start, step, unnest(range(cast(case when q - floor(q) < 1e-7 then round(q) + 1 else ceil(q) end as bigint))) as j from k)
select trace, cast(j as bigint) as j, round(start + j*step, 9) as x from e"""))
def matlab_range(spark, folder):
    n = traces.lengths(tables.samples(spark, folder))
    r = n.selectExpr("trace", "0.5e0*trace as start", "0.5e0*trace + n/4.0e0 as stop", "0.25e0*(1 + trace % 3) as step")
    x = sampled.matlab_range(r)
    return x.select("trace", "j", rnd("x", 9).alias("x"))


DW = 0.01
W0, N_W = sampled.frequencies(DW)[0], len(sampled.frequencies(DW))


@query("dispersed_wavetrain", over("b_stations", f""", t as (select unnest(range(901)) as t), w as (select {W0!r} + {DW}*unnest(range({N_W})) as w)
select station, cast(t as int) as t, round(sum(w*cos(w*t - w*d/(4 - w - w*w))*{DW}) + 0.01e0*sin(0.5e0*any_value(t))*exp(-(any_value(t)-250)*(any_value(t)-250)/500.0e0), 8) + 0.0e0 as u
from (select station, 1000.0e0 + 10*abs(lat) as d from b_stations), t, w group by station, t""".replace("0.01*unnest", "0.01e0*unnest").replace("*0.01)", "*0.01e0)")))
def dispersed_wavetrain(spark, folder):
    s = tables.stations(spark, folder).selectExpr("station", "1000.0e0 + 10*abs(lat) as d")
    t = chunks.spread(s, "station").selectExpr("station", "d", "explode(sequence(0, 900)) as t")
    return t.select("station", "t", rnd(sampled.dispersed_wavetrain("t", "d", DW), 8).alias("u"))


# ---- results kept as tables -----------------------------------------------


@query("write_adjoint_sources", over("b_pair", """, a as (select p.trace // 3 as station, i, case p.trace % 3 when 0 then 'Z' when 1 then 'N' else 'E' end as component, d - s as a from b_pair p)
select 'ev_' || station as station, i, round(coalesce(max(case when component = 'Z' then a end), 0)*2, 7) + 0.0e0 as z,
  round(coalesce(max(case when component = 'N' then a end), 0)*2, 7) + 0.0e0 as n, round(coalesce(max(case when component = 'E' then a end), 0)*2, 7) + 0.0e0 as e
from a group by station, i"""))
def write_adjoint_sources_query(spark, folder):
    a = tables.pair(spark, folder).selectExpr(
        "'event' as event", "concat('ev.', trace div 3) as station", "case trace % 3 when 0 then 'Z' when 1 then 'N' else 'E' end as component", "i", "d - s as a"
    )
    weights = a.select("station", F.lit(2.0).alias("weight")).distinct()
    path = stores.new_store(spark, "adjoint")
    write_adjoint_sources(a, weights, path)
    read = spark.read.parquet(path).where("event = 'event'")
    return read.select("station", "i", *[rnd(c, 7).alias(c) for c in "zne"])


@query("write_misfits", over("b_pair", """, m as (select trace % 10 as event, cast(trace // 3 as varchar) as station, cast(trace as varchar) as channel, sum(abs(d - s)) as misfit from b_pair group by trace)
select event, station, count(*) as channels, round(sum(misfit)*1.5e0, 5) as misfit from m group by event, station"""))
def write_misfits_query(spark, folder):
    m = tables.pair(spark, folder).groupBy("trace").agg(F.sum(F.abs(F.col("d") - F.col("s"))).alias("misfit")).selectExpr(
        "trace % 10 as event", "cast(trace div 3 as string) as station", "cast(trace as string) as channel", "misfit"
    )
    weights = m.select("station", F.lit(1.5).alias("weight")).distinct()
    path = stores.new_store(spark, "misfits")
    write_misfits(m, weights, path)
    nested = spark.read.parquet(path)
    total = F.aggregate(F.map_values("misfits"), F.lit(0.0), lambda a, x: a + x)
    return nested.select(F.col("event").cast("bigint").alias("event"), "station", F.size("misfits").cast("bigint").alias("channels"), rnd(total, 5).alias("misfit"))
