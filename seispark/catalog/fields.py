"""Queries over nodal fields, geography and space."""

from pyspark.sql import functions as F

from seispark.catalog.views import over, query
from seispark.functions import geo
from seispark.functions.columns import rnd
from seispark.operators import fields, spatial
from seispark.operators.chunks import number_sorted
from seispark.sources import stores, tables

# ---- sums, norms, clipping ------------------------------------------------


@query("sum_gradients", over("b_grad", """select param, point, round(sum(g), 6) + 0.0e0 as total,
  round(avg(g), 8) + 0.0e0 as mean, count(*) as n from b_grad group by param, point"""))
def sum_gradients(spark, folder):
    g = tables.gradients(spark, folder)
    return g.groupBy("param", "point").agg(
        rnd(F.sum("g"), 6).alias("total"), rnd(F.avg("g"), 8).alias("mean"), F.count("*").alias("n")
    )


@query("gradient_norms", over("b_grad", "select event, round(sqrt(sum(g*g)), 9) as norm from b_grad group by event"))
def gradient_norms(spark, folder):
    return fields.event_norms(tables.gradients(spark, folder)).select("event", rnd("norm", 9).alias("norm"))


@query("sum_two_params", over("b_grad", """select event, param, point, round(case when param in (0, 1) then
  sum(case when param in (0, 1) then g end) over (partition by event, point) else g end, 9) + 0.0e0 as value from b_grad"""))
def sum_two_params(spark, folder):
    merged = fields.sum_two_params(tables.gradients(spark, folder), (0, 1), keys=("event", "point"), value="g")
    return merged.select("event", "param", "point", rnd("g", 9).alias("value"))


@query("clip_quantile", over("b_grad", """, q as (select event, param, quantile_cont(g, 0.05) as low, quantile_cont(g, 0.95) as high
  from b_grad group by event, param)
select event, param, point, round(greatest(least(g, high), low), 9) + 0.0e0 as value from b_grad join q using (event, param)"""))
def clip_quantile(spark, folder):
    clipped = fields.clip_quantile(tables.gradients(spark, folder), 0.95, value="g")
    return clipped.select("event", "param", "point", rnd("g", 9).alias("value"))


@query("clip_quantile_large", """with q as (select l_returnflag as param, quantile_cont(l_extendedprice, 0.02) as low,
  quantile_cont(l_extendedprice, 0.98) as high from lineitem group by 1)
select param, count(*) as n, cast(count(*) filter (where l_extendedprice < low or l_extendedprice > high) as bigint) as clipped,
  round(min(greatest(least(l_extendedprice, high), low)), 4) as least_value,
  round(max(greatest(least(l_extendedprice, high), low)), 4) as most_value,
  round(avg(greatest(least(l_extendedprice, high), low)), 4) as mean_value
from lineitem join q on l_returnflag = param group by param""")
def clip_quantile_large(spark, folder):
    raw = tables.table(spark, folder, "lineitem").selectExpr("l_returnflag as param", "l_extendedprice as value", "l_extendedprice as raw")
    clipped = fields.clip_quantile(raw, 0.98, by=["param"])
    return clipped.groupBy("param").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("value") != F.col("raw"), 1)).alias("clipped"),
        rnd(F.min("value"), 4).alias("least_value"),
        rnd(F.max("value"), 4).alias("most_value"),
        rnd(F.avg("value"), 4).alias("mean_value"),
    )


@query("average_models", over("b_misfits", """select event, round(avg(sqrt(misfit)), 6) as value, count(*) as n from b_misfits
  where iteration between 10 and 40 group by event"""))
def average_models(spark, folder):
    models = tables.misfits(spark, folder).withColumn("misfit", F.sqrt("misfit"))
    mean = fields.average_models(models, 10, 40, ("event",), "misfit")
    n = models.where("iteration between 10 and 40").groupBy("event").agg(F.count("*").alias("n"))
    return mean.join(n, "event").select("event", rnd("misfit", 6).alias("value"), "n")


# ---- cutting regions ------------------------------------------------------

SOURCE_XYZ = """, s as (select event, (6371000.0e0-depth_m)*cos(radians(lat))*cos(radians(lon)) as sx,
  (6371000.0e0-depth_m)*cos(radians(lat))*sin(radians(lon)) as sy, (6371000.0e0-depth_m)*sin(radians(lat)) as sz from b_sources)"""
STATION_XYZ = """, r as (select distinct 6371000.0e0*cos(radians(lat))*cos(radians(lon)) as rx,
  6371000.0e0*cos(radians(lat))*sin(radians(lon)) as ry, 6371000.0e0*sin(radians(lat)) as rz from b_stations),
hit as (select distinct node from b_nodes, r where (x-rx)*(x-rx)+(y-ry)*(y-ry)+(z-rz)*(z-rz) < 600000.0e0*600000.0e0)"""


def _event_nodes(spark, folder):
    """One gradient per event: the nodes dealt out to the events."""
    return tables.nodes(spark, folder).withColumn("event", F.expr("cast(node % 25 as int)"))


def _sources_xyz(spark, folder):
    s = tables.event_sources(spark, folder)
    return s.select("event", *[c.alias(k) for k, c in geo.cartesian(F.col("lat"), F.col("lon"), "depth_m").items()])


def _stations_xyz(spark, folder):
    s = tables.stations(spark, folder)
    return s.select(*[c.alias(k) for k, c in geo.cartesian(F.col("lat"), F.col("lon")).items()])


CUT_OWN = """select node, b_nodes.node % 25 as event, cast(layer % 5 as int) as param, case when (x-sx)*(x-sx)+(y-sy)*(y-sy)+(z-sz)*(z-sz)
  < 3000000.0e0*3000000.0e0 then 0.0e0 else value end as value from b_nodes left join s on s.event = b_nodes.node % 25"""


@query("cut_source_region", over("b_nodes b_sources", SOURCE_XYZ + f"""
select node, cast(event as int) as event, round(value, 6) as value from ({CUT_OWN})"""))
def cut_source_region(spark, folder):
    cut = spatial.cut_own_source(_event_nodes(spark, folder), _sources_xyz(spark, folder), 3.0e6)
    return cut.select("node", "event", rnd("value", 6).alias("value"))


@query("cut_receiver_regions", over("b_nodes b_stations", STATION_XYZ + """
select b_nodes.node, layer, round(case when hit.node is null then value else 0.0e0 end, 6) as value
from b_nodes left join hit on b_nodes.node = hit.node"""))
def cut_receiver_regions(spark, folder):
    cut = spatial.cut_regions(tables.nodes(spark, folder), _stations_xyz(spark, folder), 6.0e5)
    return cut.select("node", "layer", rnd("value", 6).alias("value"))


@query("union_hits", over("b_nodes b_stations", STATION_XYZ + "select node from hit"))
def union_hits(spark, folder):
    return spatial.nodes_within(tables.nodes(spark, folder), _stations_xyz(spark, folder), 6.0e5).select("node")


@query("gradient_postprocess", over("b_nodes b_sources", SOURCE_XYZ + f""", c as ({CUT_OWN}),
q as (select event, param, quantile_cont(value, 0.1) as low, quantile_cont(value, 0.9) as high from c group by event, param)
select node, cast(event as int) as event, param, round(greatest(least(value, high), low), 6) as value, true as frame_set
from c join q using (event, param)"""))
def gradient_postprocess(spark, folder):
    g = _event_nodes(spark, folder).withColumn("param", F.expr("cast(layer % 5 as int)"))
    cut = spatial.cut_own_source(g, _sources_xyz(spark, folder), 3.0e6)
    clipped = fields.clip_quantile(cut, 0.9)
    return clipped.select("node", "event", "param", rnd("value", 6).alias("value"), F.lit(True).alias("frame_set"))


# ---- copying, interpolation, smoothing ------------------------------------


def _two_meshes(spark, folder):
    n = tables.nodes(spark, folder)
    source = n.selectExpr("node", "explode(map('A', value * 2, 'B', value * 3)) as (param, value)")
    return source, n.selectExpr("node", "'A' as param", "value")


COPY = """, src as (select node, 'A' as param, value * 2 as value from b_nodes union all select node, 'B', value * 3 from b_nodes),
tgt as (select node, 'A' as param, value from b_nodes)
"""


@query("copy_field", over("b_nodes", COPY + """
select 'keep' as mode, node, param, round(value, 6) as value from tgt
union all select 'add', node, param, round(value, 6) from tgt union all select 'add', node, param, round(value, 6) from src where param = 'B'
union all select 'replace', node, param, round(value, 6) from src where param = 'A'"""))
def copy_field(spark, folder):
    source, target = _two_meshes(spark, folder)
    kept = fields.copy_field(source, target, "A", overwrite=False).withColumn("mode", F.lit("keep"))
    added = fields.copy_field(source, target, "B", overwrite=False).withColumn("mode", F.lit("add"))
    replaced = fields.copy_field(source, target, "A").withColumn("mode", F.lit("replace"))
    return kept.unionByName(added).unionByName(replaced).select("mode", "node", "param", rnd("value", 6).alias("value"))


@query("interpolate_field", over("b_nodes", """, d as (select t.node, s.node as source, s.value,
  (t.x-s.x)*(t.x-s.x)+(t.y-s.y)*(t.y-s.y)+(t.z-s.z)*(t.z-s.z) as d2
  from (select node, layer, x + 20000 as x, y - 15000 as y, z + 10000 as z from b_nodes) t join b_nodes s on t.layer = s.layer),
k as (select *, row_number() over (partition by node order by d2, source) as rn, min(d2) over (partition by node) as dmin from d
  qualify rn <= 4)
select node, round(case when min(dmin) = 0 then max(case when rn = 1 then value end)
  else sum(value / nullif(d2, 0)) / sum(1 / nullif(d2, 0)) end, 5) as value, count(*) as used from k group by node"""))
def interpolate_field(spark, folder):
    given = tables.nodes(spark, folder)
    to = given.selectExpr("node", "layer", "x + 20000 as x", "y - 15000 as y", "z + 10000 as z")
    near = spatial.nearest_nodes(to, given.withColumnRenamed("node", "source"))
    weights = spatial.inverse_distance_weights(near)
    values = spatial.interpolate(weights, given.selectExpr("node as source", "'value' as param", "value"))
    used = near.groupBy("node").agg(F.count("*").alias("used"))
    return values.join(used, "node").select("node", rnd("value", 5).alias("value"), "used")


@query("smooth_field", over("b_nodes", """, n as (select *, sqrt(x*x+y*y+z*z) as r from b_nodes),
p as (select a.node, b.value, (a.r-b.r)*(a.r-b.r)/power(0.5e0*a.value*100.0e0, 2)
  + greatest((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) - (a.r-b.r)*(a.r-b.r), 0.0e0)/power(2.0e0*a.value*100.0e0, 2) as u2
  from n a, n b)
select node, round(sum(exp(-u2/2)*value)/sum(exp(-u2/2)), 5) as value from p where u2 <= 9 group by node"""))
def smooth_field(spark, folder):
    n = tables.nodes(spark, folder).withColumn("velocity", F.col("value"))
    return spatial.smooth(n, lateral=2.0, radial=0.5, min_period=100.0).select("node", rnd("value", 5).alias("value"))


# ---- projections ----------------------------------------------------------


@query("select_params", "select p_brand as param, p_partkey as node, p_retailprice as theta0 from part where p_brand in ('Brand#11', 'Brand#12')")
def select_params(spark, folder):
    return fields.select_params(tables.model(spark, folder), ["Brand#11", "Brand#12"]).select("param", "node", "theta0")


@query("zero_fill_params", over("b_nodes", """select node, layer % 5 as param,
  round(case when layer % 5 in (1, 3) then 0.0e0 else value end, 6) as value from b_nodes"""))
def zero_fill_params(spark, folder):
    n = tables.nodes(spark, folder).withColumn("param", F.expr("layer % 5"))
    return fields.zero_fill(n, [1, 3]).select("node", "param", rnd("value", 6).alias("value"))


@query("region_of_interest", over("b_nodes", """, e as (select node as element, layer, layer = 20 as fluid from b_nodes)
select element, layer, layer <= (select layer from e where fluid order by element limit 1) as roi from e"""))
def region_of_interest(spark, folder):
    e = tables.nodes(spark, folder).selectExpr("node as element", "layer", "layer = 20 as fluid")
    return fields.region_of_interest(e).select("element", "layer", "roi")


@query("layer_order", over("b_nodes", """select layer, cast(row_number() over (order by layer desc) - 1 as int) as position
  from (select distinct layer from b_nodes)"""))
def layer_order(spark, folder):
    layers = tables.nodes(spark, folder).select("layer").distinct()
    return number_sorted(layers, [F.desc("layer")], "position").select("layer", F.col("position").cast("int").alias("position"))


@query("arrange_params", """with p as (select p_partkey as node, case p_partkey % 6 when 0 then ['VS', 'VP'] when 1 then ['VP', 'VS', 'RHO']
  when 2 then ['VPV', 'VSV', 'VPH', 'VSH', 'RHO'] when 3 then ['VPV', 'VSV', 'VPH', 'VSH', 'RHO', 'QKAPPA', 'QMU', 'ETA']
  when 4 then ['RHO', 'VP', 'VS', 'QKAPPA', 'QMU'] else ['VSH', 'VSV', 'VPH', 'VPV'] end as given from part),
o as (select unnest([['VP','VS'], ['RHO','VP','VS'], ['VPV','VPH','VSV','VSH','RHO'], ['VPV','VPH','VSV','VSH','RHO','QKAPPA','QMU','ETA'],
  ['QKAPPA','QMU','RHO','VP','VS'], ['VPV','VPH','VSV','VSH']]) as known)
select node, array_to_string(known, ',') as arranged from p, o where list_sort(given) = list_sort(known)""")
def arrange_params(spark, folder):
    given = """case p_partkey % 6 when 0 then array('VS', 'VP') when 1 then array('VP', 'VS', 'RHO')
      when 2 then array('VPV', 'VSV', 'VPH', 'VSH', 'RHO') when 3 then array('VPV', 'VSV', 'VPH', 'VSH', 'RHO', 'QKAPPA', 'QMU', 'ETA')
      when 4 then array('RHO', 'VP', 'VS', 'QKAPPA', 'QMU') else array('VSH', 'VSV', 'VPH', 'VPV') end"""
    p = tables.table(spark, folder, "part").selectExpr("p_partkey as node", f"{given} as given")
    return p.select("node", F.concat_ws(",", fields.arranged(F.col("given"))).alias("arranged"))


@query("parse_dim_labels", """select p_partkey as node, 3 as n_labels, p_brand as first_label,
  '[ ' || p_brand || ' | ' || replace(p_type, ' ', '') || ' | RHO ]' as label from part""")
def parse_dim_labels(spark, folder):
    p = tables.table(spark, folder, "part").selectExpr("p_partkey as node", "concat('[ ', p_brand, ' | ', p_type, ' | RHO ]') as text")
    names = p.select("node", fields.parse_labels(F.col("text")).alias("names"))
    return names.select(
        "node", F.size("names").alias("n_labels"), F.element_at("names", 1).alias("first_label"),
        fields.join_labels(F.col("names")).alias("label"),
    )


# A mesh of all kinds of fields: what is asked for are its own fields, and each name as another kind.
MESH = """with m as (select 'nodal' as kind, p_brand as param, p_partkey as node, p_retailprice as value, null as text from part
union all select distinct 'elemental', 'VP_' || p_size % 4, cast(p_size as bigint), cast(p_size as double), null from part
union all select 'side_set', 'r' || p_size % 3, p_partkey, null, null from part where p_size < 10
union all select distinct 'global_string', p_type, null::bigint, null::double, upper(p_type) from part)
"""


def _mesh(spark, folder):
    p = tables.table(spark, folder, "part")
    none, text = "cast(null as double) as value", "cast(null as string) as text"
    nodal = p.selectExpr("'nodal' as kind", "p_brand as param", "p_partkey as node", "p_retailprice as value", text)
    elemental = p.selectExpr("'elemental' as kind", "concat('VP_', p_size % 4) as param", "cast(p_size as bigint) as node", "cast(p_size as double) as value", text).distinct()
    sides = p.where("p_size < 10").selectExpr("'side_set' as kind", "concat('r', p_size % 3) as param", "p_partkey as node", none, text)
    strings = p.selectExpr("'global_string' as kind", "p_type as param", "cast(null as bigint) as node", none, "upper(p_type) as text").distinct()
    return nodal.unionByName(elemental).unionByName(sides).unionByName(strings)


@query("has_field", MESH + """, a as (select distinct kind, param as name from m union select distinct 'elemental', param from m union select distinct 'side_set', param from m)
select kind, name, exists (select 1 from m where m.kind = a.kind and m.param = a.name) as present from a""")
def has_field(spark, folder):
    mesh = _mesh(spark, folder)
    own = mesh.select("kind", F.col("param").alias("name"))
    other = own.select(F.explode(F.array(F.lit("elemental"), F.lit("side_set"))).alias("kind"), "name")
    return fields.have_fields(mesh, own.unionByName(other).distinct())


@query("copy_mesh_field", MESH + """select mode, kind, param, count(*) as rows, round(sum(value), 4) as value, max(text) as text from (
select 'element' as mode, kind, param, value, text from m where kind <> 'elemental' union all select 'element', kind, param, value*2, text from m where kind = 'elemental' and param = 'VP_1'
union all select 'side', kind, param, value, text from m where kind = 'nodal' union all select 'side', kind, param, value*2, text from m where kind = 'side_set' and param = 'r2'
union all select 'string', kind, param, value, text from m
) group by mode, kind, param""")
def copy_mesh_field(spark, folder):
    mesh = _mesh(spark, folder)
    source = mesh.withColumn("value", F.col("value") * 2)
    element = fields.copy_field(source, mesh.where("kind <> 'elemental'"), "VP_1", kind="elemental")
    side = fields.copy_field(source, mesh.where("kind = 'nodal'"), "r2", overwrite=False, kind="side_set")
    # a string that is there stays, and a nodal field of its name would be another field
    strings = mesh.where("kind = 'global_string'").agg(F.min("param")).first()[0] or ""
    string = fields.copy_field(source.withColumn("text", F.lit("other")), mesh, strings, overwrite=False, kind="global_string")
    parts = [d.withColumn("mode", F.lit(n)) for n, d in (("element", element), ("side", side), ("string", string))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("mode", "kind", "param").agg(F.count("*").alias("rows"), rnd(F.sum("value"), 4).alias("value"), F.max("text").alias("text"))


# ---- stores ---------------------------------------------------------------


@query("read_nodal", "select p_brand as param, p_partkey as node, p_retailprice as value from part where p_brand in ('Brand#13', 'Brand#21')")
def read_nodal(spark, folder):
    m = tables.model(spark, folder).selectExpr("0 as iteration", "param", "node", "theta0 as value")
    path = stores.write_nodal(m, stores.new_store(spark, "nodal"))
    return stores.read_nodal(spark, path, 0, ["Brand#13", "Brand#21"]).select("param", "node", "value")


@query("write_nodal", over("b_model", """select param, node, round(case when param in ('Brand#11', 'Brand#22') then theta else theta0 end, 6) as value
  from b_model"""))
def write_nodal(spark, folder):
    m = tables.model(spark, folder)
    path = stores.write_nodal(m.selectExpr("0 as iteration", "param", "node", "theta0 as value"), stores.new_store(spark, "nodal"))
    new = m.where("param in ('Brand#11', 'Brand#22')").selectExpr("param", "node", "theta as value")
    stores.update_nodal(spark, path, 0, 1, new)
    return stores.read_nodal(spark, path, 1).select("param", "node", rnd("value", 6).alias("value"))


# ---- geography ------------------------------------------------------------


@query("geocentric_latitude", over("b_stations", """select station, round(case when abs(lat) < 1e-6 or abs(abs(lat) - 90) < 1e-6 then lat
  else degrees(atan((1.0e0 - (6378137.0e0*6378137.0e0 - 6356752.314245e0*6356752.314245e0)/(6378137.0e0*6378137.0e0)) * tan(radians(lat)))) end, 9)
  + 0.0e0 as latitude from b_stations"""))
def geocentric_latitude(spark, folder):
    return tables.stations(spark, folder).select("station", rnd(geo.geocentric_latitude("lat"), 9).alias("latitude"))


@query("latlondepth_to_xyz", over("b_sources", SOURCE_XYZ + "select event, round(sx, 3) + 0.0e0 as x, round(sy, 3) + 0.0e0 as y, round(sz, 3) + 0.0e0 as z from s"))
def latlondepth_to_xyz(spark, folder):
    return _sources_xyz(spark, folder).select("event", *[rnd(k, 3).alias(k) for k in "xyz"])


def _station_source(spark, folder):
    src = tables.event_sources(spark, folder).selectExpr("event", "lat as slat", "lon as slon")
    return tables.stations(spark, folder).join(src, "event")


DEG = """case when {a} = {c} and {b} = {d} then 0.0e0 else degrees(acos(greatest(least(sin(radians({a}))*sin(radians({c}))
  + cos(radians({a}))*cos(radians({c}))*cos(radians({b})-radians({d})), 1.0e0), -1.0e0))) end"""


@query("great_circle_degrees", over("b_stations b_sources", f"""select station, round({DEG.format(a='t.lat', b='t.lon', c='s.lat', d='s.lon')}, 6)
  as deg from b_stations t join b_sources s on t.event = s.event"""))
def great_circle_degrees(spark, folder):
    return _station_source(spark, folder).select("station", rnd(geo.great_circle_degrees("lat", "lon", "slat", "slon"), 6).alias("deg"))


def _vincenty_sql():
    a, b = "6378137.0e0", "6356752.314245e0"
    f = f"(({a}-{b})/{a})"
    text = f""", v0 as (select station, radians(s.lon)-radians(t.lon) as l, sin(atan((1-{f})*tan(radians(t.lat)))) as su1,
  cos(atan((1-{f})*tan(radians(t.lat)))) as cu1, sin(atan((1-{f})*tan(radians(s.lat)))) as su2, cos(atan((1-{f})*tan(radians(s.lat)))) as cu2,
  radians(s.lon)-radians(t.lon) as lam from b_stations t join b_sources s on t.event = s.event)"""
    for k in range(10):
        text += f""",
 a{k} as (select station, l, su1, cu1, su2, cu2, sqrt(power(cu2*sin(lam),2)+power(cu1*su2-su1*cu2*cos(lam),2)) as ss,
   su1*su2+cu1*cu2*cos(lam) as cs, lam from v{k}),
 b{k} as (select *, atan2(ss, cs) as sig, case when ss = 0 then 0 else cu1*cu2*sin(lam)/ss end as sa from a{k}),
 c{k} as (select *, 1-sa*sa as c2 from b{k}),
 d{k} as (select *, case when c2 = 0 then 0 else cs-2*su1*su2/c2 end as cm, {f}/16*c2*(4+{f}*(4-3*c2)) as c from c{k}),
 v{k + 1} as (select station, l, su1, cu1, su2, cu2, ss, cs, sig, c2, cm,
   l+(1-c)*{f}*sa*(sig+c*ss*(cm+c*cs*(2*cm*cm-1))) as lam from d{k})"""
    return text + f""",
 e as (select *, c2*({a}*{a}-{b}*{b})/({b}*{b}) as q from v10),
 g as (select *, 1+q/16384*(4096+q*(-768+q*(320-175*q))) as ka, q/1024*(256+q*(-128+q*(74-47*q))) as kb from e),
 km as (select station, {b}*ka*(sig-kb*ss*(cm+kb/4*(cs*(2*cm*cm-1)-kb/6*cm*(4*ss*ss-3)*(4*cm*cm-3))))/1000 as dist_km from g)"""


VINCENTY = _vincenty_sql()


@query("geodesic_km", over("b_stations b_sources", VINCENTY + " select station, round(dist_km, 6) + 0.0e0 as dist_km from km"))
def geodesic_km(spark, folder):
    d = geo.with_geodesic_km(_station_source(spark, folder), "lat", "lon", "slat", "slon")
    return d.select("station", rnd("dist_km", 6).alias("dist_km"))


PAIRS = f""", p as (select a.event, a.station as me, b.station as other, {DEG.format(a='a.lat', b='a.lon', c='b.lat', d='b.lon')} as deg
  from b_stations a join b_stations b on a.event = b.event)"""


@query("station_pairs", over("b_stations", PAIRS + """
select event, me as station, count(*) - 1 as n, round(sum(deg), 5) + 0.0e0 as sum_deg,
  round(min(case when me <> other then deg end), 5) + 0.0e0 as min_deg, round(max(deg), 5) + 0.0e0 as max_deg from p group by event, me"""))
def station_pairs(spark, folder):
    p = spatial.pair_summary(tables.stations(spark, folder))
    return p.select(
        "event", "station", "n", rnd("sum_deg", 5).alias("sum_deg"),
        rnd(F.when(F.col("n") > 0, F.col("min_deg")), 5).alias("min_deg"), rnd("max_deg", 5).alias("max_deg"),
    )


WEIGHTS = PAIRS + """,
w as (select event, me as station, case when count(*) = 1 then 1.0e0 else 1.0e0 / (sum(1.0e0/(1.0e0+deg)) - 1.0e0) end as w from p group by event, me),
sw as (select event, station, w * count(*) over (partition by event) / sum(w) over (partition by event) as weight from w)"""


@query("station_weight", over("b_stations", WEIGHTS + " select event, station, round(weight, 8) as weight from sw"))
def station_weight(spark, folder):
    w = spatial.station_weights(tables.stations(spark, folder))
    return w.select("event", "station", rnd("weight", 8).alias("weight"))


@query("build_receivers", over("b_stations", """select distinct cast(event as varchar) as network, cast(station as varchar) as station,
  round(case when abs(lat) < 1e-6 or abs(abs(lat) - 90) < 1e-6 then lat
  else degrees(atan((1.0e0 - (6378137.0e0*6378137.0e0 - 6356752.314245e0*6356752.314245e0)/(6378137.0e0*6378137.0e0)) * tan(radians(lat)))) end, 9)
  + 0.0e0 as latitude, lon as longitude from b_stations"""))
def build_receivers(spark, folder):
    s = tables.stations(spark, folder).selectExpr("cast(event as string) as network", "cast(station as string) as station", "lat", "lon")
    path = stores.new_store(spark, "receivers")
    stores.build_receivers(s, path)
    return stores.build_receivers(s, path).select("network", "station", rnd("latitude", 9).alias("latitude"), "longitude")


@query("read_receivers_json", over("b_stations", """select cast(event as varchar) as network, cast(station as varchar) as station,
  lat as latitude, lon as longitude from b_stations"""))
def read_receivers_json(spark, folder):
    per_network = tables.stations(spark, folder).selectExpr(
        "cast(event as string) as network",
        "named_struct('latitude', lat, 'longitude', lon, 'network-code', cast(event as string), 'station-code', cast(station as string)) as r",
    )
    path = stores.new_store(spark, "receivers-json")
    per_network.select(F.to_json("r").alias("value")).write.text(path)
    return stores.read_receivers_json(spark, path)


@query("receivers_with_adjoint", over("b_stations", """select cast(event as varchar) || '.' || cast(station as varchar) as receiver, lat, lon
  from b_stations where lat > 0"""))
def receivers_with_adjoint(spark, folder):
    s = tables.stations(spark, folder)
    receivers = s.selectExpr("concat_ws('.', event, station) as receiver", "lat", "lon")
    names = s.where("lat > 0").selectExpr("concat_ws(if(lon > 0, '_', '.'), event, station) as name")
    key = "translate({}, '.', '_')"
    return receivers.withColumn("k", F.expr(key.format("receiver"))).join(
        names.select(F.expr(key.format("name")).alias("k")), "k", "left_semi"
    ).drop("k")
