"""DuckDB text of the tables in sources/tables.py, for the side-by-side check."""

VIEWS = {
    "b_samples": """select user_id as trace, row_number() over (partition by user_id order by ts, event_id) - 1 as i,
  value as v from events""",
    "b_pair": """select trace, i, v as d, avg(v) over (partition by trace order by i rows between 1 preceding and 1 following) as s
  from b_samples""",
    "b_long": """select user_id % 10 as trace, row_number() over (partition by user_id % 10 order by user_id, ts, event_id) - 1 as i, value as v from events""",
    "b_long_pair": """select trace, i, v as d, avg(v) over (partition by trace order by i rows between 1 preceding and 1 following) as s from b_long""",
    "b_stations": """select s_nationkey as event, s_suppkey as station, cast((s_suppkey*37)%179-89 as double) as lat,
  cast((s_suppkey*71)%359-179 as double) as lon from supplier""",
    "b_sources": """select n_nationkey as event, cast((n_nationkey*53)%121-60 as double) as lat,
  cast((n_nationkey*97)%359-179 as double) as lon, 1000.0e0*n_regionkey as depth_m from nation""",
    "b_nodes": """select p_partkey as node, p_size as layer,
  (6371.0e0-10.0e0*p_size)*1000.0e0*cos(radians(cast((p_partkey*37)%179-89 as double)))*cos(radians(cast((p_partkey*71)%359-179 as double))) as x,
  (6371.0e0-10.0e0*p_size)*1000.0e0*cos(radians(cast((p_partkey*37)%179-89 as double)))*sin(radians(cast((p_partkey*71)%359-179 as double))) as y,
  (6371.0e0-10.0e0*p_size)*1000.0e0*sin(radians(cast((p_partkey*37)%179-89 as double))) as z, p_retailprice as value from part""",
    "b_model": """select p_brand as param, p_partkey as node, p_retailprice as theta0,
  p_retailprice*(1.0e0+0.01e0*sin(p_partkey)) as theta, cos(p_partkey)*1.0e-3 as g from part""",
    "b_misfits": """select cast((year(o_orderdate)-1995)*12+month(o_orderdate)-1 as int) as iteration,
  cast(o_custkey%100 as int) as event, o_totalprice as misfit, o_orderstatus as status from orders""",
    "b_pool": """select c_custkey as event,
  case c_mktsegment when 'BUILDING' then 'validation' when 'MACHINERY' then 'test' else 'train' end as role,
  abs(c_acctbal) as norm, cast((c_custkey*37)%179-89 as double) as lat, cast((c_custkey*71)%359-179 as double) as lon
  from customer""",
    "b_status": """select event_id as seq, user_id as event, cast(event_id%5 as int) as job_type,
  case event_type when 'signup' then 'pending' when 'view' then 'running' when 'purchase' then 'finished'
  when 'error' then 'failed' else 'unknown' end as status, ts from events""",
    "b_grad": """select event, batch, cast(pos%4 as int) as param, cast(floor(pos/4) as int) as point, cast(e as double) as g
  from (select vec_id as event, label as batch, unnest(range(len(embedding))) as pos, unnest(embedding) as e from embeddings)""",
}
NEEDS = {"b_pair": ["b_samples"], "b_long_pair": ["b_long"]}


def over(views, body, recursive=False):
    """SQL text: the named views as CTEs in front of ``body`` (which may start with ', more as (...)')."""
    names = []
    for view in views.split():
        names += [v for v in NEEDS.get(view, []) + [view] if v not in names]
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in names)
    return f"with {'recursive ' if recursive else ''}{ctes}\n{body}"


QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a query function (spark, folder) -> DataFrame and its SQL twin."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
