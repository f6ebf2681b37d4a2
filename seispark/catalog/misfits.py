"""Queries of misfits, adjoint sources and time-frequency transforms."""


from pyspark.sql import functions as F

from seispark.catalog.traces import TAPER, WINDOWS_SQL, hilbert_sql, two_windows
from seispark.catalog.views import over, query
from seispark.catalog.windows import FULL, PULSE, S
from seispark.functions.columns import rnd
from seispark.operators import misfit, timefrequency, traces
from seispark.operators.chunks import attach
from seispark.plans.waveforms import event_job, station_distances
from seispark.session import materialise
from seispark.sources import tables
from seispark.sources.stores import new_store

WIN_TAPER = TAPER.format(i="(p.i - start)", n="(stop - start + 1)", r="least(2.0e0/(stop - start), 0.5e0)")
TAPERED = WINDOWS_SQL + f""", tp as (select p.trace, win, p.i, start, stop, d*{WIN_TAPER} as d, s*{WIN_TAPER} as s, {WIN_TAPER} as tw
  from b_pair p join w on p.trace = w.trace and p.i between start and stop)
"""
CCC = """, cs as (select trace, win, sum(d*d) as oo, sum(s*s) as ss, sum(d*s) as os from tp group by trace, win)
"""


def _pair(spark, folder):
    return materialise(tables.pair(spark, folder), "pair")


def _tapered(spark, folder):
    p = _pair(spark, folder)
    return p, misfit.window_taper(p, two_windows(p), 4.0)


@query("window_taper", over("b_pair", TAPERED + "select trace, win, i, round(d, 7) + 0.0e0 as d, round(s, 7) + 0.0e0 as s from tp"))
def window_taper(spark, folder):
    return _tapered(spark, folder)[1].select("trace", "win", "i", rnd("d", 7).alias("d"), rnd("s", 7).alias("s"))


@query("ccc_misfit", over("b_pair", TAPERED + CCC + "select trace, round(sum(1 - os/sqrt(oo*ss)), 9) + 0.0e0 as misfit, count(*) as windows from cs group by trace"))
def ccc_misfit(spark, folder):
    m, _ = misfit.ccc(_tapered(spark, folder)[1], {"dt": 1.0})
    return m.groupBy("trace").agg(rnd(F.sum("misfit"), 9).alias("misfit"), F.count("*").alias("windows"))


@query("ccc_adjoint", over("b_pair", TAPERED + CCC + """select tp.trace, tp.win, i, round((d - os/ss*s)/sqrt(oo*ss), 10) + 0.0e0 as a
  from tp join cs on cs.trace = tp.trace and cs.win = tp.win"""))
def ccc_adjoint(spark, folder):
    _, a = misfit.ccc(_tapered(spark, folder)[1], {"dt": 1.0})
    return a.select("trace", "win", "i", rnd("a", 10).alias("a"))


@query("adjoint_sources", over("b_pair", TAPERED + CCC + """, ad as (select tp.trace, i, sum((d - os/ss*s)/sqrt(oo*ss)*tw) as a from tp
  join cs on cs.trace = tp.trace and cs.win = tp.win group by tp.trace, i)
select p.trace, p.i, round(coalesce(a, 0), 10) + 0.0e0 as a from b_pair p left join ad on ad.trace = p.trace and ad.i = p.i"""))
def adjoint_sources(spark, folder):
    p = _pair(spark, folder)
    _, a = misfit.adjoint_sources("ccc", p, two_windows(p), 4.0, 20.0)
    return a.select("trace", "i", rnd("a", 10).alias("a"))


@query("envelope_scaling", over("b_pair", """, u as (select trace, i, d/(max(d) over w - min(d) over w) as v, s/(max(s) over w - min(s) over w) as s, max(s) over w - min(s) over w as ps
  from b_pair window w as (partition by trace))""" + hilbert_sql("hb", "u") + """, e as (select u.*, sqrt(v*v + h*h) as e from u join hb on hb.trace = u.trace and hb.i = u.i),
t as (select trace, i, v, s, ps, 1/(e + 0.3e0*max(e) over (partition by trace)) as w from e)
select trace, i, round(v*w, 7) as d, round(s*w, 7) as s, round(w/ps, 9) as chain from t"""))
def envelope_scaling(spark, folder):
    e = misfit.envelope_scaling(_pair(spark, folder))
    return e.select("trace", "i", rnd("d", 7).alias("d"), rnd("s", 7).alias("s"), rnd("chain", 9).alias("chain"))


# ---- time-frequency -------------------------------------------------------

WIDTH = 8.0
G = f"(power(pi()*{WIDTH}e0*{WIDTH}e0, -0.25e0)*exp(-0.5e0*({{x}})*({{x}})/({WIDTH}e0*{WIDTH}e0)))"
GABOR = f""", gw as (select k.trace, k.i as k, m.i as m, m.s * {G.format(x='m.i - k.i')} as f, max(abs(m.s)) over (partition by k.trace) as top
  from b_pair k join b_pair m on m.trace = k.trace),
gn as (select trace, count(*) as n from b_pair group by trace),
gk as (select trace, k from gw group by trace, k having max(abs(f)) >= 0.01e0*any_value(top)),
gf as (select gw.trace, gw.k, gw.m, f, n from gw join gk on gk.trace = gw.trace and gk.k = gw.k join gn on gn.trace = gw.trace)
"""


@query("gabor_transform", over("b_pair", GABOR + f""", z as (select g.trace, g.k, l.l, sum(f*cos(2*pi()*((m*l.l) % n)/n)) as re, -sum(f*sin(2*pi()*((m*l.l) % n)/n)) as im
  from gf g join (select trace, unnest(range(n)) as l from gn) l on l.trace = g.trace group by 1, 2, 3)
select trace, cast(l as int) as l, round(sum(re)/sqrt(2*pi()), 6) + 0.0e0 as re, round(sum(im)/sqrt(2*pi()), 6) + 0.0e0 as im,
  round(sum(re*re + im*im)/(2*pi()), 4) as power from z group by trace, l"""))
def gabor_transform(spark, folder):
    t = timefrequency.cells(timefrequency.gabor(_pair(spark, folder), WIDTH))
    return t.groupBy("trace", "l").agg(
        rnd(F.sum("re"), 6).alias("re"), rnd(F.sum("im"), 6).alias("im"), rnd(F.sum(F.col("re") ** 2 + F.col("im") ** 2), 4).alias("power")
    )


@query("inverse_tf", over("b_pair", GABOR + f""", sp as (select trace, k, sum(f) as top from gf group by 1, 2),
ok as (select trace, k from (select *, max(top) over (partition by trace) as most from sp) where top >= 0.01e0*most)
select g.trace, g.m as i, round(sum(f*{G.format(x='m - g.k')}), 6) + 0.0e0 as signal from gf g join ok on ok.trace = g.trace and ok.k = g.k group by g.trace, g.m"""))
def inverse_tf(spark, folder):
    t = timefrequency.gabor(_pair(spark, folder), WIDTH, tops=True)
    return timefrequency.inverse(t, WIDTH).select("trace", "i", rnd("re", 6).alias("signal"))


ODD = ", od as (select * from (select *, count(*) over (partition by trace) as n0 from b_pair) where i < n0 - 1 + n0 % 2)"
CORR = f""", cw as (select k.trace, k.i as k, m.i as m, m.d*{G.format(x='m.i - k.i')} as a, m.s*{G.format(x='m.i - k.i')} as b,
  max(abs(m.d)) over (partition by k.trace) as top from {{src}} k join {{src}} m on m.trace = k.trace),
cn as (select trace, count(*) as n from {{src}} group by trace),
ck as (select trace, k from cw group by 1, 2 having least(max(abs(a)), max(abs(b))) >= 0.01e0*any_value(top)),
cj as (select trace, n, unnest(range(n)) as j from cn),
cf as (select w.trace, w.k, j.j, n, sum(a*cos(2*pi()*((m*j.j) % (2*n-1))/(2*n-1))) as ar, -sum(a*sin(2*pi()*((m*j.j) % (2*n-1))/(2*n-1))) as ai,
  sum(b*cos(2*pi()*((m*j.j) % (2*n-1))/(2*n-1))) as br, -sum(b*sin(2*pi()*((m*j.j) % (2*n-1))/(2*n-1))) as bi
  from cw w join ck on ck.trace = w.trace and ck.k = w.k join cj j on j.trace = w.trace group by 1, 2, 3, 4),
cc as (select trace, k, j, n, br*ar + bi*ai as re, bi*ar - br*ai as im from cf),
cl as (select trace, n, l, least(l, n - l) as q, least(l, n - l)*(2*n-1)/(1.0e0*n) as pos, l > (n-1)/2 as neg from (select trace, n, unnest(range(n)) as l from cn)),
ci as (select l.trace, c.k, l.l, l.n, c.re + (d.re - c.re)*(pos - floor(pos)) as re, (c.im + (d.im - c.im)*(pos - floor(pos)))*(case when neg then -1 else 1 end) as im
  from cl l join cc c on c.trace = l.trace and c.j = floor(pos) join cc d on d.trace = l.trace and d.k = c.k and d.j = floor(pos) + 1),
ct as (select trace, k, l, n, re/sqrt(2*pi()) as re, im/sqrt(2*pi()) as im from ci)
"""


@query("tf_cross_correlation", over("b_pair", ODD + CORR.format(src="od") + """select trace, cast(l as int) as l, round(sum(re), 4) + 0.0e0 as re, round(sum(im), 4) + 0.0e0 as im,
  round(sum(sqrt(re*re + im*im)), 4) as size from ct group by trace, l"""))
def tf_cross_correlation(spark, folder):
    p = _pair(spark, folder)
    odd = attach(p, traces.lengths(p)).where("i < n - 1 + n % 2")
    t = timefrequency.cells(timefrequency.correlation_spectra(odd, WIDTH))
    return t.groupBy("trace", "l").agg(
        rnd(F.sum("re"), 4).alias("re"), rnd(F.sum("im"), 4).alias("im"), rnd(F.sum(F.hypot("re", "im")), 4).alias("size")
    )


TF_MISFIT = ODD + CORR.format(src="od") + """
, mm as (select trace, max(sqrt(re*re + im*im))/10 as m from ct group by trace),
ph as (select ct.trace, k, l, n, atan2(im, re) as phase, (1 - exp(-(re*re + im*im)/(m*m)))*(1 - exp(-power(20.0e0*l/n, 2)))
  *(case when l/(1.0e0*n) <= 0.25e0 then 1.0e0 else exp(-10*abs(4.0e0*l/n - 1)) end) as raw from ct join mm on mm.trace = ct.trace),
nw as (select *, raw/max(raw) over (partition by trace) as w, raw*phase/max(abs(raw*phase)) over (partition by trace) as x from ph),
pl as (select trace, sqrt(sum(w*w*phase*phase)/any_value(n)) as plain from nw group by trace),
gx as (select g.trace, g.k, g.l, coalesce(x, 0) as x from (select trace, k, l from (select trace, unnest(range(n)) as k from cn) join (select trace, unnest(range(n)) as l from cn) using (trace)) g
  left join nw on nw.trace = g.trace and nw.k = g.k and nw.l = g.l),
st as (select *, abs(lead(x) over (partition by trace, l order by k) - x) > 0.7e0 as down, abs(lead(x) over (partition by trace, k order by l) - x) > 0.7e0 as side from gx),
ju as (select trace, count(*) filter (where down) + count(*) filter (where side) as jumps from st group by trace)
select pl.trace, round(plain, 7) + 0.0e0 as plain, jumps, round(plain*(case when jumps > 7 then 2 else 1 end), 7) + 0.0e0 as misfit from pl join ju on ju.trace = pl.trace"""


@query("tf_phase_misfit", over("b_pair", TF_MISFIT))
def tf_phase_misfit(spark, folder):
    m, _ = timefrequency.phase_misfit(_pair(spark, folder).select("trace", "i", "d", "s"), 4.0, 20.0)
    return m.select("trace", rnd("plain", 7).alias("plain"), "jumps", rnd("misfit", 7).alias("misfit"))


# Every window of a trace is a series of the trace's length, zero outside the window; its key is ten times the trace and the window.
SERIES = TAPERED + """, sr as (select p.trace*10 + w.win as trace, p.i, coalesce(tp.d, 0) as d, coalesce(tp.s, 0) as s, count(*) over (partition by p.trace, w.win) as n0
  from b_pair p join w on w.trace = p.trace left join tp on tp.trace = p.trace and tp.win = w.win and tp.i = p.i),
so as (select * from sr where i < n0 - 1 + n0 % 2)"""
TF_ADJOINT = SERIES + CORR.format(src="so") + TF_MISFIT[TF_MISFIT.index("\n, mm as") : TF_MISFIT.index("\nselect pl.trace, round(plain")] + f"""
, sw as (select k.trace, k.i as k, m.i as m, m.s * {G.format(x='m.i - k.i')} as f, max(abs(m.s)) over (partition by k.trace) as top from so k join so m on m.trace = k.trace),
sk as (select trace, k from sw group by trace, k having max(abs(f)) >= 0.01e0*any_value(top)),
sf as (select x.trace, x.k, nw.l, sum(f*cos(2*pi()*((m*nw.l) % n)/n))/sqrt(2*pi()) as sr, -sum(f*sin(2*pi()*((m*nw.l) % n)/n))/sqrt(2*pi()) as si
  from sw x join sk on sk.trace = x.trace and sk.k = x.k join nw on nw.trace = x.trace and nw.k = x.k group by 1, 2, 3),
kz as (select sf.trace, sf.k, sf.l, n, w*w*phase*sr/(m + sr*sr + si*si) as zr, w*w*phase*si/(m + sr*sr + si*si) as zi
  from sf join nw on nw.trace = sf.trace and nw.k = sf.k and nw.l = sf.l join mm on mm.trace = sf.trace),
kk as (select trace, k from (select trace, k, max(sqrt(zr*zr + zi*zi)) as own, max(max(sqrt(zr*zr + zi*zi))) over (partition by trace) as top from kz group by trace, k) where own >= 0.01e0*top),
back as (select z.trace, cn.i, sum((zr*sin(2*pi()*((l*cn.i) % z.n)/z.n) + zi*cos(2*pi()*((l*cn.i) % z.n)/z.n))/z.n*{G.format(x='cn.i - z.k')})*sqrt(2*pi()) as a
  from kz z join kk on kk.trace = z.trace and kk.k = z.k join (select trace, unnest(range(n)) as i from cn) cn on cn.trace = z.trace group by 1, 2),
adj as (select back.trace // 10 as trace, back.trace % 10 as win, i, case when jumps > 7 then 0 else a/(plain + 2.220446049250313e-16) end as a
  from back join pl on pl.trace = back.trace join ju on ju.trace = back.trace),
total as (select adj.trace, adj.i, sum(a*tw) as a from adj join tp on tp.trace = adj.trace and tp.win = adj.win and tp.i = adj.i group by 1, 2)
select p.trace, p.i, round(coalesce(a, 0), 6) + 0.0e0 as a from b_pair p left join total on total.trace = p.trace and total.i = p.i where p.trace in (select trace from w)"""


@query("tf_phase_adjoint", over("b_pair", TF_ADJOINT))
def tf_phase_adjoint(spark, folder):
    p = _pair(spark, folder)
    _, a = misfit.adjoint_sources("tf_phase_misfit", p, two_windows(p), 4.0, 20.0)
    return a.select("trace", "i", rnd("a", 6).alias("a"))


# ---- the whole job --------------------------------------------------------

# Traces bound to stations for the job: three components a station, a place near the source of its event, and an origin
# 7 s before the first sample. Every other trace starts one sample late, every one ends two samples early; one station in
# eleven has a second tag and is left out. The first trace of an event stands for its source pulse.
JOB_PAIR = """with b_samples as ({samples}), whole as ({pair}), wn as (select trace, count(*) as n from whole group by trace),
raw_pair as (select whole.trace, i - whole.trace % 2 as i, d, s from whole join wn on wn.trace = whole.trace
  where i >= whole.trace % 2 and i < n - 2 and (whole.trace // 3) % 11 <> 0),
b_pair as (select trace, i, d*(max(s) over w - min(s) over w)/(max(d) over w - min(d) over w) as d, s from raw_pair window w as (partition by trace)),
b_sources as ({sources}),
b_stations as (select distinct b_sources.event, trace // 3 as station, lat + 0.1e0*(1 + (trace // 3) % 10) as lat, lon
  from whole join b_sources on b_sources.event = (trace // 3) % 25),
fp as (select (trace // 3) % 25 as event, min(trace) as trace from whole group by 1),
pb as (select fp.event as trace, i, v from b_samples join fp on fp.trace = b_samples.trace)
"""
PULSES = hilbert_sql("hp", "pb") + """, pe as (select s.trace, s.i, sqrt(v*v + h*h) as e from pb s join hp on hp.trace = s.trace and hp.i = s.i),
pk as (select trace, i as peak, e as top from pe qualify row_number() over (partition by trace order by e desc, i) = 1),
pu as (select pk.trace as event, coalesce(min(pe.i), any_value(peak)) as pulse from pk left join pe on pe.trace = pk.trace and pe.i >= peak and pe.e < 0.5*top group by pk.trace)
"""


def _job_sql():
    from seispark.catalog.fields import VINCENTY, WEIGHTS
    from seispark.catalog.views import VIEWS

    head = JOB_PAIR.format(samples=VIEWS["b_samples"], pair=VIEWS["b_pair"], sources=VIEWS["b_sources"]) + VINCENTY + WEIGHTS.replace(", p as", ", spair as").replace("from p group", "from spair group") + PULSES
    full = FULL.replace("10.0e0*(1 + st.trace % 10) as dist_km", "(select dist_km from km where km.station = st.trace // 3) as dist_km")
    full = full.replace("2) + 3 as bigint) as max_idx", "2) + (select pulse from pu where pu.event = (ac.trace // 3) % 25) as bigint) as max_idx")
    tapered = TAPERED.replace(WINDOWS_SQL, ", w2 as (select trace, start as win, start, stop from fin)").replace("join w on p.trace = w.trace", "join w2 w on p.trace = w.trace")
    body = full + tapered + CCC + """, per as (select trace, sum(1 - os/sqrt(oo*ss)) as misfit, count(*) as windows from cs group by trace),
ad as (select tp.trace, i, sum((d - os/ss*s)/sqrt(oo*ss)*tw) as a from tp join cs on cs.trace = tp.trace and cs.win = tp.win group by tp.trace, i),
sz as (select trace, sqrt(sum(a*a)) as size from ad group by trace),
long as (select trace // 3 as station, max(i) + 1 as n from b_pair where trace in (select trace from per) group by 1)
select per.trace // 3 as station, any_value(sw.event) as event, any_value(long.n) as samples, round(any_value(dist_km), 5) as dist_km, count(*) as components,
  round(sum(misfit*weight), 8) + 0.0e0 as misfit,
  round(coalesce(max(case when per.trace % 3 = 0 then size*weight end), 0), 8) + 0.0e0 as z,
  round(coalesce(max(case when per.trace % 3 = 1 then size*weight end), 0), 8) + 0.0e0 as n,
  round(coalesce(max(case when per.trace % 3 = 2 then size*weight end), 0), 8) + 0.0e0 as e
from per join sz on sz.trace = per.trace join sw on sw.station = per.trace // 3 join km on km.station = per.trace // 3
join long on long.station = per.trace // 3 group by 1"""
    return head + body


def _bound(spark, folder):
    """Headers and samples of data and synthetics, stations, origins and pulses from the test tables."""
    whole = materialise(tables.pair(spark, folder), "pair")
    station, event = "trace div 3", "(trace div 3) % 25"
    channel = "case trace % 3 when 0 then 'BHZ' when 1 then 'BHN' else 'BHE' end"
    ends = traces.lengths(whole)
    d = attach(whole, ends).where("i >= trace % 2 and i < n - 2").selectExpr("trace", "i - trace % 2 as i", "d as v")
    s = whole.selectExpr("trace", "i", "s as v")
    headers = ends.selectExpr("trace", f"{event} as event", f"{station} as station", f"{channel} as channel", "explode(if((trace div 3) % 11 = 0, array('a', 'b'), array('a'))) as tag")
    observed = headers.selectExpr("event", "station", "channel", "tag", "1007.0e0 + trace % 2 as t0", "1.0e0 as dt")
    synthetic = headers.where("tag = 'a'").selectExpr("event", "station", "channel", "tag", "0.0e0 as t0", "1.0e0 as dt")

    def rows(samples):
        return samples.selectExpr(f"{event} as event", f"{station} as station", f"{channel} as channel", "'a' as tag", "i", "v")

    origins = tables.event_sources(spark, folder).selectExpr("cast(event as bigint) as event", "1000.0e0 as time", "lat", "lon")
    places = headers.select("event", "station").distinct().join(origins.drop("time"), "event")
    stations = places.selectExpr("event", "station", "lat + 0.1e0*(1 + station % 10) as lat", "lon")
    first = headers.groupBy("event").agg(F.min("trace").alias("trace"))
    pulses = tables.samples(spark, folder).join(first, "trace").select("event", "i", "v")
    return (observed, rows(d)), (synthetic, rows(s)), stations, origins, pulses


@query("event_processing_job", _job_sql())
def event_processing_job(spark, folder):
    observed, synthetic, stations, origins, pulses = _bound(spark, folder)
    path = new_store(spark, "event-job")
    event_job(observed, synthetic, materialise(stations, "stations"), origins, S, path, start_time=7.0, pulses=pulses)
    adjoint = spark.read.parquet(f"{path}/adjoint")
    sizes = adjoint.groupBy("event", F.col("station").cast("bigint").alias("station")).agg(
        F.count("*").alias("samples"), *[rnd(F.sqrt(F.sum(F.col(c) ** 2)), 8).alias(c) for c in "zne"]
    )
    nested = spark.read.parquet(f"{path}/misfits")
    total = F.aggregate(F.map_values("misfits"), F.lit(0.0), lambda a, x: a + x)
    misfits = nested.select("event", "station", F.size("misfits").cast("bigint").alias("components"), rnd(total, 8).alias("misfit"))
    far = station_distances(stations, origins).select("event", "station", rnd("dist_km", 5).alias("dist_km"))
    both = sizes.join(misfits, ["event", "station"]).join(far, ["event", "station"])
    return both.select(F.col("event").cast("int").alias("event"), "station", "samples", "dist_km", "components", "misfit", "z", "n", "e")
