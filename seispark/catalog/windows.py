"""Queries of the time-window selection, stage by stage and as a whole."""

from pyspark.sql import functions as F

from seispark.catalog.traces import hilbert_sql
from seispark.catalog.views import over, query
from seispark.functions.columns import rnd
from seispark.operators import traces, windows
from seispark.operators.chunks import attach, runs
from seispark.session import materialise
from seispark.sources import tables

S = windows.Settings(min_period=4.0, max_period=20.0, max_noise=1.0)
STRICT = windows.Settings(min_period=4.0, max_period=20.0)
PULSE = 3

STATS = """, st as (select trace, count(*) as n, max(d)-min(d) as ptp_d, max(s)-min(s) as ptp_s, max(abs(d)) as max_d, max(abs(s)) as max_s,
  sum(d*s)/(sqrt(sum(d*d))*sqrt(sum(s*s))) as cc from b_pair group by trace),
ar as (select p.trace, min(i) as first from b_pair p join st on st.trace = p.trace where abs(s) > 5e-3*max_s group by p.trace),
nz as (select p.trace, max(abs(d)) as noise, max(abs(d))/any_value(max_d) as noise_relative from b_pair p join st on st.trace = p.trace
  join ar on ar.trace = p.trace where i < greatest(floor(0.9*first), 1) group by p.trace),
ac as (select st.*, first, noise, noise_relative, 10.0e0*(1 + st.trace % 10) as dist_km from st join ar on ar.trace = st.trace join nz on nz.trace = st.trace)
"""
BOUNDS = STATS + """, bo as (select *, greatest(first - 4, 0) as min_idx, cast(ceil(dist_km/2.4e0 + 2) + 3 as bigint) as max_idx from ac
  where dist_km >= 19.2 and noise_relative <= 1.0 and not (cc < 0.1 and noise_relative > 1.0/3))
"""
HOPS = BOUNDS + """, hop as (select trace, cast(unnest(range(n - 8)) as bigint) as start from st where n >= 9),
hb0 as (select h.trace, h.start, h.start + 4 as mid, min_idx < h.start + 4 and h.start + 4 < max_idx as ok, ptp_s from hop h join bo on bo.trace = h.trace),
hw as (select h.trace, h.start, p.i - h.start as k, d*(0.5e0 - 0.5e0*cos(2*pi()*(p.i - h.start)/8)) as a, s*(0.5e0 - 0.5e0*cos(2*pi()*(p.i - h.start)/8)) as b
  from hb0 h join b_pair p on p.trace = h.trace and p.i between h.start and h.start + 8 where ok),
hl as (select a.trace, a.start, a.k - b.k as lag, sum(a.a*b.b) as c from hw a join hw b on a.trace = b.trace and a.start = b.start group by 1, 2, 3),
hm as (select trace, start, lag, c from hl qualify row_number() over (partition by trace, start order by c desc, lag) = 1),
he as (select trace, start, max(b)-min(b) as pb, sum(a*a) as ea, sum(b*b) as eb from hw group by 1, 2),
sl as (select hb0.trace, mid as i, pb >= 0.001e0*ptp_s as energetic, case when pb >= 0.001e0*ptp_s then lag/4.0e0 end as shift,
  case when pb >= 0.001e0*ptp_s then c/sqrt(eb*ea) end as cc from hb0 join hm on hm.trace = hb0.trace and hm.start = hb0.start
  join he on he.trace = hb0.trace and he.start = hb0.start),
sm as (select p.trace, p.i, p.d, p.s, sl.shift, sl.cc, coalesce(sl.energetic, false) as energetic, sl.trace is not null as covered, min_idx, max_idx
  from b_pair p join bo on bo.trace = p.trace left join sl on sl.trace = p.trace and sl.i = p.i),
lp as (select *, coalesce(abs(lead(shift) over (partition by trace order by i) - shift) > 0.1, false) as leap from sm),
jm as (select *, bool_or(leap) over (partition by trace order by i rows between current row and 1 following) as jump from lp)
"""
ENVELOPES = hilbert_sql("hd", "b_pair", "d") + hilbert_sql("hs", "b_pair", "s") + """, en as (select p.trace, p.i, sqrt(d*d + a.h*a.h) as ed, sqrt(s*s + b.h*b.h) as es
  from b_pair p join hd a on a.trace = p.trace and a.i = p.i join hs b on b.trace = p.trace and b.i = p.i),
ec as (select trace, i, greatest(ed, 0.1e0*max(ed) over (partition by trace)) as a, greatest(es, 0.1e0*max(es) over (partition by trace)) as b from en),
er as (select trace, i, least(a, b)/greatest(a, b) as ratio from ec)
"""


def islands(name, source):
    return f""", {name} as (select trace, min(i) as start, max(i) + 1 as stop from
  (select trace, i, i - row_number() over (partition by trace order by i) as g from {source}) group by trace, g)
"""


VALID = """, va as (select jm.trace, jm.i from jm join er on er.trace = jm.trace and er.i = jm.i where jm.i > min_idx and jm.i < max_idx
  and coalesce(cc, 0) >= 0.75 and abs(coalesce(shift, 0)) <= 0.3 and not jump and ratio >= 0.2)
"""


def extrema_sql(p, ranges):
    """CTE {p}x(trace, lo, hi, syn, i, peak): extrema of data and synthetics in each range."""
    return f""", {p}s as (select r.trace, r.start as lo, r.stop as hi, syn, i, case when syn then s else d end as v from {ranges} r
  join b_pair p on p.trace = r.trace and i >= start and i < stop, (select unnest([false, true]) as syn)),
{p}t as (select *, v > pv as up from (select *, lag(v) over (partition by trace, lo, syn order by i) as pv from {p}s) where v <> pv),
{p}n as (select trace, lo, hi, syn, i, up as peak from (select *, lead(up) over (partition by trace, lo, syn order by i) as nu from {p}t) where up <> nu),
{p}e as (select trace, lo, hi, syn, min(i) filter (where peak) as p0, min(i) filter (where not peak) as t0,
  max(i) filter (where peak) as p1, max(i) filter (where not peak) as t1 from {p}n group by 1, 2, 3, 4),
{p}x as (select trace, lo, hi, syn, i, peak from {p}n union all select trace, lo, hi, syn, lo, p0 is null or coalesce(t0 < p0, false) from {p}e
  union all select trace, lo, hi, syn, hi - 1, p1 is null or coalesce(p1 < t1, false) from {p}e)
"""


def march_sql(p):
    return f""", {p}d as (select *, row_number() over (partition by trace, lo, peak order by i) as pos from {p}x where not syn),
{p}m as (select x.trace, x.lo, x.peak, x.i, d.pos from {p}x x join {p}d d on d.trace = x.trace and d.lo = x.lo and d.peak = x.peak where x.syn
  qualify row_number() over (partition by x.trace, x.lo, x.peak, x.i order by abs(d.i - x.i), d.i desc) = 1),
{p}i as (select trace, coalesce(pi, lo) as start, ni as stop from (select *, lead(pos) over w as np, lead(i) over w as ni, lag(i) over w as pi from {p}m
  window w as (partition by trace, lo, peak order by i)) where np - pos = 1),
{p}u as (select distinct p.trace, p.i from b_pair p join {p}i r on r.trace = p.trace and p.i >= r.start and p.i < r.stop)
""" + islands(f"{p}r", f"{p}u")


def counted_sql(p, ranges):
    return extrema_sql(p, ranges) + f""", {p}c as (select trace, lo as start, hi as stop from {p}x group by 1, 2, 3
  having least(count(*) filter (where syn and peak), count(*) filter (where syn and not peak),
    count(*) filter (where not syn and peak), count(*) filter (where not syn and not peak)) >= 2)
"""


def energy_sql(p, ranges):
    return f""", {p} as (select r.trace, r.start, r.stop, sum(d*d) as ed, sum(s*s) as es from {ranges} r join b_pair p on p.trace = r.trace
  and i >= start and i < stop group by 1, 2, 3 having greatest(sum(d*d), sum(s*s)) <= 10*least(sum(d*d), sum(s*s)))
"""


FULL = (
    HOPS + ENVELOPES + VALID + islands("ru", "va") + ", rl as (select * from ru where stop - start >= 6)" + extrema_sql("x", "rl") + march_sql("x")
    + counted_sql("k", "xr") + ", kl as (select * from kc where stop - start >= 6)" + energy_sql("fin", "kl")
)


def _pair(spark, folder):
    return materialise(tables.pair(spark, folder), "pair")


def _distances(pair):
    return pair.select("trace").distinct().withColumn("dist_km", F.expr("10.0e0*(1 + trace % 10)"))


def _accepted(pair, s=S):
    return windows.accept_traces(pair, _distances(pair), s)


def _bounds(pair, s=S):
    return windows.travel_bounds(_accepted(pair, s).where("reason is null"), s, PULSE)


def _slid(spark, folder):
    p = _pair(spark, folder)
    b = materialise(_bounds(p), "bounds")
    return p, b, windows.sliding_correlation(attach(p, b.select("trace", "n", "ptp_s", "min_idx", "max_idx")), S)


@query("first_arrival", over("b_pair", STATS + "select trace, first from ar"))
def first_arrival(spark, folder):
    p = _pair(spark, folder)
    return windows.first_arrival(p, traces.trace_stats(p))


@query("noise_level", over("b_pair", STATS + "select trace, round(noise, 6) as noise, round(noise_relative, 9) as noise_relative from nz"))
def noise_level(spark, folder):
    p = _pair(spark, folder)
    st = traces.trace_stats(p)
    n = windows.noise_level(p, windows.first_arrival(p, st), st)
    return n.select("trace", rnd("noise", 6).alias("noise"), rnd("noise_relative", 9).alias("noise_relative"))


@query("accept_trace", over("b_pair", STATS + """select trace, case when dist_km < 19.2 then 'distance' when noise_relative > 0.1 then 'noise'
  when cc < 0.1 and noise_relative > 0.1/3 then 'correlation' else 'accepted' end as verdict from ac"""))
def accept_trace(spark, folder):
    return _accepted(_pair(spark, folder), STRICT).select("trace", F.coalesce("reason", F.lit("accepted")).alias("verdict"))


@query("traveltime_mask", over("b_pair", BOUNDS + "select p.trace, i, i > min_idx and i < max_idx as valid, i > min_idx as valid_global from b_pair p join bo on bo.trace = p.trace"))
def traveltime_mask(spark, folder):
    p = _pair(spark, folder)
    b = _bounds(p).select("trace", "n", "min_idx", "max_idx")
    return attach(p, b).select("trace", "i", F.expr("i > min_idx and i < max_idx").alias("valid"), F.expr("i > min_idx and i < n").alias("valid_global"))


@query("hop_windows", over("b_pair", STATS + """select trace, cast(start as bigint) as start, cast(start + 9 as bigint) as stop, cast(start + 4 as bigint) as mid
  from (select trace, unnest(range(n - 8)) as start from st where n >= 9)"""))
def hop_windows(spark, folder):
    return windows.hop_windows(traces.lengths(tables.pair(spark, folder)), S)


@query("sliding_xcorr", over("b_pair", HOPS + "select trace, i, covered, round(shift, 6) + 0.0e0 as shift, round(cc, 8) + 0.0e0 as cc from sm"))
def sliding_xcorr(spark, folder):
    return _slid(spark, folder)[2].select("trace", "i", "covered", rnd("shift", 6).alias("shift"), rnd("cc", 8).alias("cc"))


@query("no_energy_mask", over("b_pair", HOPS + "select trace, i, covered and not energetic as excluded from sm"))
def no_energy_mask(spark, folder):
    return _slid(spark, folder)[2].select("trace", "i", F.expr("covered and not energetic").alias("excluded"))


@query("cc_mask", over("b_pair", HOPS + "select trace, i, coalesce(cc, 0) < 0.75 as excluded from sm"))
def cc_mask(spark, folder):
    return _slid(spark, folder)[2].select("trace", "i", (F.coalesce("cc", F.lit(0.0)) < S.threshold_correlation).alias("excluded"))


@query("shift_mask", over("b_pair", HOPS + "select trace, i, abs(coalesce(shift, 0)) > 0.3 as excluded from sm"))
def shift_mask(spark, folder):
    return _slid(spark, folder)[2].select("trace", "i", (F.abs(F.coalesce("shift", F.lit(0.0))) > S.threshold_shift).alias("excluded"))


@query("shift_jump_mask", over("b_pair", HOPS + "select trace, i, jump as excluded from jm"))
def shift_jump_mask(spark, folder):
    return windows.shift_jumps(_slid(spark, folder)[2], S).select("trace", "i", F.col("jump").alias("excluded"))


@query("envelope_ratio_mask", over("b_pair", ENVELOPES + "select trace, i, round(ratio, 7) as ratio, ratio < 0.2 as excluded from er"))
def envelope_ratio_mask(spark, folder):
    r = windows.envelope_ratio(_pair(spark, folder), S)
    return r.select("trace", "i", rnd("ratio", 7).alias("ratio"), (F.col("ratio") < S.min_envelope_similarity).alias("excluded"))


LOUD = ", lo as (select trace, i from b_pair where d > 25)"


def _runs(spark, folder):
    p = tables.pair(spark, folder)
    return p, runs(p.where("d > 25"))


@query("contiguous_runs", over("b_pair", LOUD + islands("ru", "lo") + "select trace, cast(start as bigint) as start, cast(stop as bigint) as stop from ru"))
def contiguous_runs(spark, folder):
    return _runs(spark, folder)[1].select("trace", "start", "stop")


@query("min_length_runs", over("b_pair", LOUD + islands("ru", "lo") + "select trace, cast(start as bigint) as start, cast(stop as bigint) as stop from ru where stop - start >= 6"))
def min_length_runs(spark, folder):
    return windows.keep_long(_runs(spark, folder)[1], S).select("trace", "start", "stop")


@query("local_extrema", over("b_pair", ", ra as (select trace, 0 as start, cast(count(*) as bigint) as stop from b_pair group by trace)" + extrema_sql("x", "ra")
                             + "select trace, syn as synthetic, cast(i as bigint) as i, peak from xx"))
def local_extrema(spark, folder):
    p = _pair(spark, folder)
    whole = traces.lengths(p).selectExpr("trace", "0L as start", "n as stop")
    return windows.range_extrema(p, whole).selectExpr("t as trace", "synthetic", "i", "peak")


@query("union_extrema", over("b_samples", """, x as (select *, lag(v) over w as pv, lead(v) over w as nv from (select trace, i, round(v/20) as v from b_samples) window w as (partition by trace order by i)),
t as (select *, v > pv as up from x where v <> pv), n as (select *, lead(up) over (partition by trace order by i) as nu from t)
select trace, i, up as peak, v = nv as flat from n where up <> nu"""))
def union_extrema(spark, folder):
    s = tables.samples(spark, folder).withColumn("v", F.floor(F.col("v") / 20 + 0.5).cast("double"))
    s = materialise(s, "steps")
    empty = s.where("false").selectExpr("trace", "0 as lo", "0 as hi")
    found = windows.extrema(s, empty)
    return windows.mark_flat(s, found)


LOUD_RUNS = LOUD + islands("ru", "lo") + ", rl as (select * from ru where stop - start >= 4)"


def _loud(spark, folder):
    p = _pair(spark, folder)
    r = runs(p.where("d > 25")).where("stop - start >= 4")
    return p, materialise(r, "runs")


@query("peak_trough_marching", over("b_pair", LOUD_RUNS + extrema_sql("x", "rl") + march_sql("x") + "select trace, cast(start as bigint) as start, cast(stop as bigint) as stop from xr"))
def peak_trough_marching(spark, folder):
    p, r = _loud(spark, folder)
    return windows.merge_ranges(p, windows.march(windows.range_extrema(p, r))).select("trace", "start", "stop")


@query("extrema_count_filter", over("b_pair", LOUD_RUNS + counted_sql("k", "rl") + "select trace, cast(start as bigint) as start, cast(stop as bigint) as stop from kc"))
def extrema_count_filter(spark, folder):
    p, r = _loud(spark, folder)
    return windows.enough_extrema(p, r, S)


@query("energy_ratio_filter", over("b_pair", LOUD_RUNS + energy_sql("f", "rl").replace("10*least", "1.3*least")
                                   + "select trace, cast(start as bigint) as start, cast(stop as bigint) as stop, round(ed, 4) as ed, round(es, 4) as es from f"))
def energy_ratio_filter(spark, folder):
    p, r = _loud(spark, folder)
    kept = windows.balanced_energy(p, r, windows.Settings(4.0, 20.0, max_energy_ratio=1.3))
    return kept.select("trace", "start", "stop", rnd("ed", 4).alias("ed"), rnd("es", 4).alias("es"))


@query("index_to_time", over("b_pair", LOUD_RUNS + """, t0 as (select user_id as trace, min(epoch_us(ts)) as t0 from events group by 1)
select rl.trace, t0 + start*500000 as t_start_us, t0 + stop*500000 as t_end_us, 1.0e0 as weight from rl join t0 on t0.trace = rl.trace"""))
def index_to_time(spark, folder):
    p, r = _loud(spark, folder)
    t0 = tables.table(spark, folder, "events").groupBy(F.col("user_id").alias("trace")).agg(F.min(F.col("ts").cast("timestamp")).alias("t0"))
    timed = windows.index_to_time(r.join(t0, "trace"), 0.5)
    return timed.select("trace", F.unix_micros("t_start").alias("t_start_us"), F.unix_micros("t_end").alias("t_end_us"), "weight")


@query("select_windows", over("b_pair", FULL + "select trace, cast(start as bigint) as start, cast(stop as bigint) as stop from fin"))
def select_windows(spark, folder):
    p = _pair(spark, folder)
    return windows.select_windows(p, _distances(p), S, PULSE)


@query("window_everything", over("b_pair", BOUNDS + "select trace, cast(min_idx as bigint) as start, cast(max_idx as bigint) as stop from bo"))
def window_everything(spark, folder):
    p = _pair(spark, folder)
    return windows.select_windows(p, _distances(p), S, PULSE, window_everything=True)


@query("only_stations_with_windows", over("b_pair", LOUD_RUNS + "select p.trace, count(*) as n from b_pair p where p.trace in (select trace from rl where stop - start >= 6) group by p.trace"))
def only_stations_with_windows(spark, folder):
    p, r = _loud(spark, folder)
    some = windows.keep_long(r, S).select("trace").distinct()
    return p.join(some, "trace", "left_semi").groupBy("trace").agg(F.count("*").alias("n"))


@query("pulse_width", over("b_samples", hilbert_sql("hb", "b_samples") + """, e as (select s.trace, s.i, sqrt(v*v + h*h) as e from b_samples s join hb on hb.trace = s.trace and hb.i = s.i),
p as (select trace, i as peak, e as top from e qualify row_number() over (partition by trace order by e desc, i) = 1)
select p.trace, cast(coalesce(min(e.i), any_value(peak)) as bigint) as pulse from p left join e on e.trace = p.trace and e.i >= peak and e.e < 0.5*top group by p.trace"""))
def pulse_width(spark, folder):
    return windows.pulse_width(materialise(tables.samples(spark, folder), "pulse"))
