"""Queries of the model update, batch choice and ledger."""

from pyspark.sql import functions as F

from seispark.catalog.views import over, query
from seispark.functions import names
from seispark.functions.columns import rnd
from seispark.operators import batch, chunks, ledger, quantiles, spatial, update
from seispark.plans.iteration import IterationJob, model_for_event, sum_and_merge
from seispark.session import materialise
from seispark.sources import stores, tables

# ---- gradient sums of an iteration ----------------------------------------


@query("sum_and_merge", over("b_grad", """, t as (select * from b_grad where event not in (select event from b_grad where batch = 9)),
s as (select param, point, sum(g) as value from t group by param, point)
select 'gradient' as kind, param as id, point, round(case when param in (0, 1) then
  sum(case when param in (0, 1) then value end) over (partition by point) else value end, 6) + 0.0e0 as value from s
union all select 'norm', cast(event as int), -1, round(sqrt(sum(g*g)), 6) from t group by event"""))
def sum_and_merge_query(spark, folder):
    g = tables.gradients(spark, folder)
    validation = tables.table(spark, folder, "embeddings").where("label = 9").selectExpr("vec_id as event")
    total, norms = sum_and_merge(g, validation, (0, 1))
    a = total.select(F.lit("gradient").alias("kind"), F.col("param").alias("id"), "point", rnd("value", 6).alias("value"))
    b = norms.select(F.lit("norm").alias("kind"), F.col("event").cast("int").alias("id"), F.lit(-1).alias("point"), rnd("norm", 6).alias("value"))
    return a.unionByName(b)


@query("upsert_gradient_norms", over("b_misfits", """, n as (select iteration, event, sqrt(sum(misfit*misfit)) as norm from b_misfits group by iteration, event)
select event, iteration, round(norm, 4) as norm from n qualify row_number() over (partition by event order by iteration desc) = 1"""))
def upsert_gradient_norms(spark, folder):
    n = tables.misfits(spark, folder).groupBy("iteration", "event").agg(F.sqrt(F.sum(F.col("misfit") ** 2)).alias("norm"))
    path = stores.new_store(spark, "norms")
    n.write.mode("append").parquet(path)
    return ledger.latest(spark.read.parquet(path), ["event"], ["iteration"]).select("event", "iteration", rnd("norm", 4).alias("norm"))


# ---- model update ---------------------------------------------------------


@query("join_reference_model", over("b_model", "select param, node, round(theta/theta0 - 1, 12) + 0.0e0 as perturbation from b_model where theta0 <> 0"))
def join_reference_model(spark, folder):
    m = tables.model(spark, folder)
    joined = update.join_reference(m.select("param", "node", "theta"), m.select("param", "node", "theta0"))
    return joined.select("param", "node", rnd(update.relative_perturbation("theta", "theta0"), 12).alias("perturbation"))


@query("relative_perturbation", over("b_model", "select node, round(case when theta0 <> 0 then theta/theta0 - 1 end, 12) + 0.0e0 as perturbation from b_model"))
def relative_perturbation(spark, folder):
    return tables.model(spark, folder).select("node", rnd(update.relative_perturbation("theta", "theta0"), 12).alias("perturbation"))


@query("join_moments", over("b_model", "select param, node, round(g, 12) as g, case when theta0 > 1500 then theta0 else 0.0e0 end as m from b_model"))
def join_moments(spark, folder):
    m = tables.model(spark, folder)
    moments = m.where("theta0 > 1500").selectExpr("param", "node", "theta0 as m")
    return update.join_moments(m.select("param", "node", rnd("g", 12).alias("g")), moments, ["m"])


ADAM = update.Adam(scaling=1.0)
SGDM = update.Momentum()
ADAM_1 = """, s as (select param, node, theta0, theta, 0.1e0*g as m, 0.001e0*g*g as v from b_model),
raw as (select *, 0.001e0*(m/0.1e0)/(sqrt(v/0.001e0) + 0.1e0*avg(sqrt(v/0.001e0)) over ()) as upd from s)"""
SGDM_1 = """, raw as (select param, node, theta0, theta, 0.001e0*(0.1e0*g)/0.1e0 as upd from b_model)"""
SMOOTHED = """, sm as (select *, upd*(0.6e0 + 0.3e0*cos(node)) as supd from raw)"""


def _raw(spark, folder, rule):
    m = tables.model(spark, folder)
    moments = rule.moments(m.select("param", "node", "g"), None)
    return m, rule.raw_update(moments, 0)


def _damped(raw):
    return raw.withColumn("update", F.col("update") * (0.6 + 0.3 * F.cos("node")))


@query("adam_raw_update", over("b_model", ADAM_1 + "select param, node, round(upd, 12) + 0.0e0 as upd from raw"))
def adam_raw_update(spark, folder):
    return _raw(spark, folder, ADAM)[1].select("param", "node", rnd("update", 12).alias("upd"))


@query("sgdm_raw_update", over("b_model", SGDM_1 + "select param, node, round(upd, 15) + 0.0e0 as upd from raw"))
def sgdm_raw_update(spark, folder):
    return _raw(spark, folder, SGDM)[1].select("param", "node", rnd("update", 15).alias("upd"))


@query("update_norms", over("b_model", ADAM_1 + SMOOTHED + """select round(max(abs(upd)), 10) as max_raw, round(sqrt(sum(upd*upd)), 10) as norm_raw,
  round(max(abs(supd)), 10) as max_smooth, round(sqrt(sum(supd*supd)), 10) as norm_smooth from sm"""))
def update_norms(spark, folder):
    raw = _raw(spark, folder, ADAM)[1]
    n = update.update_norms(raw, _damped(raw))
    return n.select(*[rnd(c, 10).alias(c) for c in n.columns])


APPLIED = "select param, node, round(case when theta0 <> 0 then ((theta/theta0-1)*(1-{decay}) - supd*{factor} + 1)*theta0 else 0 end, 6) as theta from sm"


@query("adam_apply_update", over("b_model", ADAM_1 + SMOOTHED + """, f as (select least(sqrt(sum(upd*upd))/sqrt(sum(supd*supd)),
  0.001e0/max(abs(supd)), max(abs(upd))/max(abs(supd))) as factor from sm) """ + APPLIED.format(decay="0.001e0", factor="(select factor from f)")))
def adam_apply_update(spark, folder):
    m, raw = _raw(spark, folder, ADAM)
    new = ADAM.apply(raw, _damped(raw), m.select("param", "node", "theta0"), m.select("param", "node", "theta"))
    return new.select("param", "node", rnd("theta", 6).alias("theta"))


@query("sgdm_apply_update", over("b_model", SGDM_1 + SMOOTHED + """, f as (select 0.001e0/max(abs(supd)) as factor from sm) """
                                 + APPLIED.format(decay="0.0001e0", factor="(select factor from f)")))
def sgdm_apply_update(spark, folder):
    m, raw = _raw(spark, folder, SGDM)
    new = SGDM.apply(raw, _damped(raw), m.select("param", "node", "theta0"), m.select("param", "node", "theta"))
    return new.select("param", "node", rnd("theta", 6).alias("theta"))


@query("nan_guard", """select l_returnflag as param, cast(count(*) filter (where isnan(case when l_discount = 0 then 'nan'::double else l_tax/l_discount end)) as bigint) as nans,
  count(*) filter (where l_discount = 0) = 0 as accepted,
  case when count(*) filter (where l_discount = 0) = 0 then count(*) else 0 end as kept from lineitem group by 1""")
def nan_guard(spark, folder):
    rows = tables.table(spark, folder, "lineitem").selectExpr(
        "l_returnflag as param", "case when l_discount = 0 then double('NaN') else l_tax/l_discount end as v"
    )
    judged = update.verdicts(rows, ["param"], F.isnan("v"))
    # the guard itself runs over the groups it lets pass, and every row has to come through
    passed = update.no_nan(rows.join(judged.where("accepted").select("param"), "param", "left_semi"), "v", "the values")
    kept = passed.groupBy("param").agg(F.count("v").alias("kept"))
    return judged.join(kept, "param", "left").select("param", F.col("refused").alias("nans"), "accepted", F.coalesce("kept", F.lit(0)).alias("kept"))


TIGHT = 0.9 * ADAM.alpha


@query("magnitude_guard", over("b_model", ADAM_1 + """select param, round(max(abs(upd)), 10) as largest,
  count(*) filter (where abs(upd) > 0.9e0*0.001e0) as refused, max(abs(upd)) <= 0.9e0*0.001e0 as accepted,
  max(abs(upd)) <= 3*0.001e0 as within_rule from raw group by param"""))
def magnitude_guard(spark, folder):
    m = tables.model(spark, folder)
    raw = ADAM.unchecked_update(ADAM.moments(m.select("param", "node", "g"), None), 0)
    judged = update.verdicts(raw, ["param"], update.too_large("update", TIGHT))
    rule = update.verdicts(raw, ["param"], update.too_large("update", 3 * ADAM.alpha)).select("param", F.col("accepted").alias("within_rule"))
    sizes = raw.groupBy("param").agg(rnd(F.max(F.abs("update")), 10).alias("largest"))
    return sizes.join(judged, "param").join(rule, "param").select("param", "largest", "refused", "accepted", "within_rule")


PERIOD, LATERAL, RADIAL = 100.0, 2.0, 0.5
PARAMS = {"RHO": 1.5, "VPV": 1.0, "VPH": 1.1}

JOB = """, pr as (select unnest(['RHO', 'VPV', 'VPH']) as param, unnest([1.5e0, 1.0e0, 1.1e0]) as part, unnest([1, 2, 3]) as k),
x0 as (select param, node, value*part as theta0, value*part*(1.0e0 + 0.01e0*sin(node + k)) as theta, 0.0e0 as m, 0.0e0 as v from b_nodes, pr),
e as (select unnest([1, 2, 3]) as event),
sp as (select pr.param, node, x, y, z, sqrt(x*x + y*y + z*z) as r, value*(case pr.param when 'VPH' then 1.1e0 else 1.0e0 end)*100.0e0 as sc from b_nodes, pr),
near as (select a.param, a.node, b.node as other, (a.r-b.r)*(a.r-b.r)/power(0.5e0*a.sc, 2)
  + greatest((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) - (a.r-b.r)*(a.r-b.r), 0.0e0)/power(2.0e0*a.sc, 2) as u2
  from sp a join sp b on a.param = b.param),
w as materialized (select param, node, other, exp(-u2/2) as w from near where u2 <= 9)"""
RULES = {
    "adam": (
        "0.9e0*m + (1-0.9e0)*g as m, 0.999e0*v + (1-0.999e0)*g*g as v",
        "0.001e0*(m/{b1!r})/(sqrt(v/{b2!r}) + 0.1e0*avg(sqrt(v/{b2!r})) over ())",
        "least(sqrt(sum(upd*upd))/sqrt(sum(supd*supd)), 0.001e0/max(abs(supd)), max(abs(upd))/max(abs(supd)))",
        "0.001e0",
    ),
    "momentum": ("m, 0.9e0*v + (1-0.9e0)*g as v", "0.001e0*v/{b1!r}", "0.001e0/max(abs(supd))", "0.1e0*0.001e0"),
}


def _iterations_sql(n, rule):
    state, step, factor, decay = RULES[rule]
    text = JOB
    for k in range(n):
        b1, b2 = 1 - 0.9 ** (k + 1), 1 - 0.999 ** (k + 1)
        text += f""",
g{k} as (select param, node, avg(cos(node*event + {k})*1.0e-3*k) as g from b_nodes, pr, e group by param, node),
t{k} as (select param, node, case when param <> 'RHO' then sum(case when param <> 'RHO' then g end) over (partition by node) else g end as g from g{k}),
m{k} as (select x{k}.param, x{k}.node, theta0, theta, {state} from x{k} join t{k} on x{k}.param = t{k}.param and x{k}.node = t{k}.node),
r{k} as (select *, {step.format(b1=b1, b2=b2)} as upd from m{k}),
h{k} as (select w.param, w.node, sum(w*upd)/sum(w) as supd from w join r{k} on r{k}.param = w.param and r{k}.node = w.other group by w.param, w.node),
s{k} as (select r{k}.*, supd from r{k} join h{k} on h{k}.param = r{k}.param and h{k}.node = r{k}.node),
f{k} as (select {factor} as factor from s{k}),
x{k + 1} as (select param, node, theta0, case when theta0 <> 0 then ((theta/theta0-1)*(1-{decay}) - supd*(select factor from f{k}) + 1)*theta0
  else 0 end as theta, m, v from s{k})"""
    return text + f""" select param, node, round(theta, 5) as value from x{n} union all
select 'norm', event, round(sqrt(sum(power(cos(node*event + {n - 1})*1.0e-3*k, 2))), 8) from b_nodes, pr, e group by event"""


def _run_iterations(spark, folder, rule, n):
    """n iterations over three events and one validation event; model and the last norms."""
    nodes = tables.nodes(spark, folder)
    params = F.explode(F.array(*[F.struct(F.lit(p).alias("param"), F.lit(x).alias("part"), F.lit(k + 1).alias("k")) for k, (p, x) in enumerate(PARAMS.items())]))
    dealt = nodes.hint("rebalance", "node")  # few tasks read a file of few row groups, and would leave as few files
    full = materialise(dealt.withColumn("p", params).select("node", "x", "y", "z", "value", "p.*"), "nodes")
    start = full.selectExpr("param", "node", "value*part as theta0", "value*part*(1.0e0 + 0.01e0*sin(node + k)) as theta")
    speeds = full.where("param <> 'RHO'").selectExpr("param", "node", "value*part as velocity")

    smoother = spatial.ParameterSmoother(nodes.select("node", "x", "y", "z"), speeds, list(PARAMS), LATERAL, RADIAL, PERIOD)
    job = IterationJob(spark, stores.new_store(spark, "inversion"), rule, smoother, ("VPV", "VPH"))
    job.start(start)
    validation = spark.range(4, 5).select(F.col("id").cast("int").alias("event"))
    for k in range(n):
        per_event = full.withColumn("event", F.explode(F.sequence(F.lit(1), F.lit(4)))).selectExpr(
            "event", "param", "node", f"if(event = 4, 1.0e3, cos(node*event + {k})*1.0e-3*k) as g"
        )
        model = job.run(k, per_event, validation)
    norms = job.norms(n - 1).select(F.lit("norm").alias("param"), F.col("event").cast("bigint").alias("node"), rnd("norm", 8).alias("value"))
    return model.select("param", "node", rnd("theta", 5).alias("value")).unionByName(norms)


@query("iteration_job", over("b_nodes", _iterations_sql(3, "adam")))
def iteration_job(spark, folder):
    return _run_iterations(spark, folder, ADAM, 3)


@query("momentum_job", over("b_nodes", _iterations_sql(2, "momentum")))
def momentum_job(spark, folder):
    return _run_iterations(spark, folder, SGDM, 2)


@query("validation_model", over("b_pool b_model", """, t as (select it as iteration, theta0*(1.0e0+0.01e0*it*sin(node)) as theta from b_model, (select unnest(range(5)) as it)),
n as (select 'model_00004' as model, sqrt(sum(theta*theta)) as size from t where iteration = 4 union all
  select 'average_00002_00004', sqrt(sum(a*a)) from (select avg(theta0*(1.0e0+0.01e0*it*sin(node))) as a from b_model, (select unnest([2,3,4]) as it) group by param, node))
select event, role, n.model, round(size, 3) as model_norm from b_pool join n on n.model = case when role = 'validation' then 'average_00002_00004' else 'model_00004' end"""))
def validation_model(spark, folder):
    models = tables.model(spark, folder).selectExpr("param", "node", "theta0", "explode(sequence(0, 4)) as iteration").withColumn(
        "value", F.expr("theta0*(1.0e0+0.01e0*iteration*sin(node))")
    )
    names_ = model_for_event(tables.pool(spark, folder), 4, 3)
    from seispark.operators.fields import average_models

    current = models.where("iteration = 4").select(F.lit("model_00004").alias("model"), "value")
    mean = average_models(models, 2, 4).select(F.lit("average_00002_00004").alias("model"), "value")
    sizes = current.unionByName(mean).groupBy("model").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("size"))
    return names_.join(sizes, "model").select("event", "role", "model", rnd("size", 3).alias("model_norm"))


# ---- batch choice ---------------------------------------------------------

SEEN = ", seen as (select distinct o_custkey as event from orders where o_orderstatus = 'P')"
SEEN_NORMS = SEEN + ", norms as (select event, norm from b_pool where event in (select event from seen))"


def _seen(spark, folder):
    return tables.table(spark, folder, "orders").where("o_orderstatus = 'P'").selectExpr("o_custkey as event").distinct()


def _norms(spark, folder):
    return tables.pool(spark, folder).join(_seen(spark, folder), "event", "left_semi").select("event", "norm")


@query("split_role", "select c_custkey as event, c_mktsegment = 'BUILDING' as is_validation from customer")
def split_role(spark, folder):
    p = tables.pool(spark, folder)
    listed = p.where("role = 'validation'").select("event", F.lit(True).alias("listed"))
    return p.join(listed, "event", "left").select("event", F.coalesce("listed", F.lit(False)).alias("is_validation"))


@query("blocked_set", "select c_custkey as event from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def blocked_set(spark, folder):
    return batch.blocked(tables.pool(spark, folder))


@query("event_pool", "select c_custkey as event from customer where c_mktsegment not in ('BUILDING', 'MACHINERY')")
def event_pool(spark, folder):
    return batch.event_pool(tables.pool(spark, folder)).select("event")


@query("remaining_events", over("b_pool", SEEN + "select event from b_pool where role <> 'validation' and event not in (select event from seen)"))
def remaining_events(spark, folder):
    wanted = tables.pool(spark, folder).where("role <> 'validation'").select("event")
    return wanted.subtract(_seen(spark, folder))


@query("unseen_events", over("b_pool", SEEN_NORMS + "select event from b_pool where role = 'train' and event not in (select event from norms)"))
def unseen_events(spark, folder):
    return batch.event_pool(tables.pool(spark, folder)).select("event").subtract(_norms(spark, folder).select("event"))


@query("norm_percentile", over("b_pool", SEEN_NORMS + "select round(quantile_cont(norm, 0.65), 6) as norm, count(*) as known from norms"))
def norm_percentile(spark, folder):
    n = _norms(spark, folder)
    q = quantiles.exact_quantiles(n, [], "norm", {"fill": 0.65}).select("fill").scalar()
    return n.agg(F.count("*").alias("known")).select(rnd(q, 6).alias("norm"), "known")


def _pick_sql(size):
    deg = """case when c.lat = p.lat and c.lon = p.lon then 0.0e0 else degrees(acos(greatest(least(sin(radians(c.lat))*sin(radians(p.lat))
      + cos(radians(c.lat))*cos(radians(p.lat))*cos(radians(c.lon)-radians(p.lon)), 1.0e0), -1.0e0))) end"""
    text = SEEN_NORMS + """, fill as (select quantile_cont(norm, 0.65) as f from norms),
c as (select p.event, lat, lon, coalesce(n.norm, f) as norm from b_pool p left join norms n on p.event = n.event, fill where role = 'train'),
p0 as (select 0 as round, event, lat, lon, norm as score from c order by norm desc, event limit 1)"""
    for k in range(1, size):
        text += f""",
a{k} as ({' union all '.join(f'select * from p{j}' for j in range(k))}),
p{k} as (select {k} as round, event, lat, lon, score from (select c.event, c.lat, c.lon, min({deg})*any_value(c.norm) as score
  from c, a{k} p where c.event not in (select event from a{k}) group by c.event, c.lat, c.lon) order by score desc, event limit 1)"""
    return text + f" select round, event, round(score, 5) as score from ({' union all '.join(f'select * from p{j}' for j in range(size))})"


def _candidates(spark, folder):
    return batch.fill_norms(batch.event_pool(tables.pool(spark, folder)), _norms(spark, folder))


@query("pick_minibatch", over("b_pool", _pick_sql(5)))
def pick_minibatch(spark, folder):
    picked = batch.pick_minibatch(materialise(_candidates(spark, folder), "candidates"), 5)
    return picked.select("round", "event", rnd("score", 5).alias("score"))


@query("union_validation", over("b_pool", _pick_sql(3).replace(" select round, event, round(score, 5) as score from", ", pick as (select event from")
       + ") select event, 'train' as role from pick union all select event, role from b_pool where role = 'validation'"))
def union_validation(spark, folder):
    return batch.events_of_iteration(tables.pool(spark, folder), _norms(spark, folder), 3, 5, 3)


FIRST = _pick_sql(4).replace("coalesce(n.norm, f) as norm", "1.0e0 as norm")


@query("first_iteration_events", over("b_pool", FIRST.replace(" select round, event, round(score, 5) as score from", ", pick as (select event from")
       + ") select event, 'train' as role from pick union all select event, role from b_pool where role = 'validation'"))
def first_iteration_events(spark, folder):
    return batch.events_of_iteration(tables.pool(spark, folder), _norms(spark, folder).limit(0), 4, 0, 3)


@query("validation_due", over("b_misfits", """, i as (select distinct iteration from b_misfits), v as (select unnest([0, 3, 5]) as every)
select iteration, every, case when every = 0 then false else iteration = 0 or (iteration + 1) % every = 0 end as due from i, v"""))
def validation_due(spark, folder):
    i = tables.misfits(spark, folder).select("iteration").distinct().withColumn("every", F.explode(F.array(F.lit(0), F.lit(3), F.lit(5))))
    return i.withColumn("due", batch.validation_due("iteration", "every"))


# ---- ledger ---------------------------------------------------------------

ROLE = "case when event % 10 = 0 then 'validation' else 'train' end"


def _event_rows(spark, folder):
    return tables.misfits(spark, folder).select("iteration", "event").distinct().withColumn("role", F.expr(ROLE))


INIT = """, e as (select distinct iteration, event from b_misfits),
j as (select unnest(['forward', 'adjoint', 'prepare_forward', 'gradient_interp', 'hpc_processing']) as job_type),
led as (select iteration, event, job_type, false as submitted, false as retrieved, 0 as reposts,
  case when event % 10 <> 0 then 0.0e0 end as misfit, case when event % 10 <> 0 then false end as usage_updated
  from e, j where event % 10 <> 0 or job_type in ('forward', 'prepare_forward'))
"""


def _ledger(spark, folder):
    return ledger.init_iteration(_event_rows(spark, folder))


@query("init_iteration_ledger", over("b_misfits", INIT + "select * from led"))
def init_iteration_ledger(spark, folder):
    return _ledger(spark, folder)


@query("ledger_bulk_update", over("b_misfits", INIT + """select iteration, event, job_type, submitted, retrieved,
  case when iteration = 12 and job_type = 'adjoint' then 2 when iteration = 13 and event = 7 then 5 else reposts end as reposts from led"""))
def ledger_bulk_update(spark, folder):
    changed = ledger.bulk_update(_ledger(spark, folder), "reposts", 2, 12, job_type="adjoint")
    return ledger.bulk_update(changed, "reposts", 5, 13, event=7).select(
        "iteration", "event", "job_type", "submitted", "retrieved", "reposts"
    )


@query("rollback_iterations", over("b_misfits", INIT + """select iteration, event, job_type, iteration <> 20 as submitted,
  iteration <> 20 as retrieved, case when iteration = 20 then 0 else 1 end as reposts from led where iteration <= 20"""))
def rollback_iterations(spark, folder):
    done = _ledger(spark, folder).withColumns({"submitted": F.lit(True), "retrieved": F.lit(True), "reposts": F.lit(1)})
    return ledger.rollback(done, 20).select("iteration", "event", "job_type", "submitted", "retrieved", "reposts")


@query("rollback_records", over("b_misfits", INIT + """select 'ledger' as name, iteration, count(*) as rows, round(sum(case when iteration = 20 then 0 else 1 end), 4) + 0.0e0 as total from led where iteration <= 20 group by 2
union all select 'misfits', iteration, count(*), round(sum(misfit), 4) from b_misfits where iteration < 20 group by 2
union all select 'norms', iteration, count(distinct event), round(sqrt(sum(misfit*misfit)), 4) from b_misfits where iteration < 20 group by 2
union all select 'model', iteration, count(*), round(max(misfit), 4) from b_misfits where iteration <= 20 group by 2"""))
def rollback_records(spark, folder):
    m = tables.misfits(spark, folder)
    done = _ledger(spark, folder).withColumns({"submitted": F.lit(True), "retrieved": F.lit(True), "reposts": F.lit(1)})
    back = ledger.rollback_records({"ledger": done, "misfits": m, "norms": m, "model": m}, 20)

    def summed(name, rows, total):
        return back[name].groupBy("iteration").agg(rows.alias("rows"), rnd(total, 4).alias("total")).select(F.lit(name).alias("name"), "iteration", "rows", "total")

    out = summed("ledger", F.count("*"), F.sum(F.col("reposts").cast("double")))
    out = out.unionByName(summed("misfits", F.count("*"), F.sum("misfit")))
    out = out.unionByName(summed("norms", F.count_distinct("event"), F.sqrt(F.sum(F.col("misfit") ** 2))))
    return out.unionByName(summed("model", F.count("*"), F.max("misfit")))


@query("update_iteration_ledger", over("b_status", """select event, job_type, status, seq from b_status
  qualify row_number() over (partition by event, job_type order by ts desc, seq desc) = 1"""))
def update_iteration_ledger(spark, folder):
    path = stores.new_store(spark, "job-state")
    s = tables.status(spark, folder)
    s.where("status = 'pending'").write.mode("append").parquet(path)
    s.where("status <> 'pending'").write.mode("append").parquet(path)
    rows = spark.read.schema(s.schema).parquet(path)
    return ledger.latest(rows, ["event", "job_type"], ["ts", "seq"]).select("event", "job_type", "status", "seq")


@query("read_old_iteration", over("b_misfits", "select event, status, count(*) as rows, round(sum(misfit), 2) as misfit from b_misfits where iteration = 17 group by 1, 2"))
def read_old_iteration(spark, folder):
    path = stores.new_store(spark, "iterations")
    # few files for each iteration, and a large iteration over several tasks
    tables.misfits(spark, folder).hint("rebalance", F.col("iteration")).write.partitionBy("iteration").parquet(path)
    return stores.read_iteration(spark, path, 17).groupBy("event", "status").agg(
        F.count("*").alias("rows"), rnd(F.sum("misfit"), 2).alias("misfit")
    )


@query("usage_counter", over("b_misfits", "select event, count(distinct iteration) as used from b_misfits where event % 10 <> 0 group by event"))
def usage_counter(spark, folder):
    return ledger.usage_counts(tables.misfits(spark, folder).where(f"{ROLE} = 'train'"))


@query("used_event_count", """select count(distinct c_custkey) as events, count(distinct case when o_custkey is not null then c_custkey end) as used
  from customer left join orders on o_custkey = c_custkey""")
def used_event_count(spark, folder):
    used = tables.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("event")).agg(F.count("*").alias("used"))
    all_events = tables.pool(spark, folder).select("event").join(used, "event", "left")
    return all_events.agg(F.count("*").alias("events"), F.count(F.when(F.col("used") > 0, 1)).alias("used"))


@query("register_new_events", over("b_pool", SEEN + "select event, 0 as used from b_pool where event not in (select event from seen)"))
def register_new_events(spark, folder):
    return ledger.register_new(tables.pool(spark, folder), _seen(spark, folder))


@query("write_event_list", "select 'event_' || c_custkey as event from customer")
def write_event_list(spark, folder):
    path = stores.new_store(spark, "event-list")
    tables.pool(spark, folder).selectExpr("concat('event_', event) as event").write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "event")


REPORT = "case when event is null then 'total' else cast(event as varchar) end"


@query("aggregate_report", over("b_misfits", f"""select iteration, {REPORT} as event, round(sum(misfit), 2) as misfit, count(*) as windows
  from b_misfits group by grouping sets ((iteration, event), (iteration))"""))
def aggregate_report(spark, folder):
    m = tables.misfits(spark, folder)
    per_event = m.groupBy("iteration", "event").agg(F.sum("misfit").alias("misfit"), F.count("*").alias("windows"))
    both = per_event.groupingSets([["iteration", "event"], ["iteration"]], "iteration", "event").agg(
        rnd(F.sum("misfit"), 2).alias("misfit"), F.sum("windows").alias("windows")
    )
    return both.select("iteration", F.coalesce(F.col("event").cast("string"), F.lit("total")).alias("event"), "misfit", "windows")


@query("event_misfit", over("b_misfits", """select iteration, event, round(sum(misfit), 2) as misfit,
  cast(grouping(iteration)*2 + grouping(event) as int) as level from b_misfits group by rollup(iteration, event)"""))
def event_misfit(spark, folder):
    return ledger.misfit_rollup(tables.misfits(spark, folder)).select("iteration", "event", rnd("misfit", 2).alias("misfit"), "level")


@query("control_group_misfit", over("b_misfits", """select iteration, round(sum(case when event % 7 = 0 then misfit end), 2) as old_group,
  round(sum(case when event % 5 = 0 then misfit end), 2) as new_group from b_misfits group by iteration"""))
def control_group_misfit(spark, folder):
    c = ledger.control_group(tables.misfits(spark, folder), F.col("event") % 7 == 0, F.col("event") % 5 == 0)
    return c.select("iteration", rnd("old_group", 2).alias("old_group"), rnd("new_group", 2).alias("new_group"))


@query("validation_totals", over("b_misfits", "select iteration, round(sum(misfit), 2) as total, count(distinct event) as events from b_misfits where event % 10 = 0 group by iteration"))
def validation_totals(spark, folder):
    v = tables.misfits(spark, folder).where(f"{ROLE} = 'validation'").groupBy("iteration", "event").agg(F.sum("misfit").alias("misfit"))
    return v.groupBy("iteration").agg(rnd(F.sum("misfit"), 2).alias("total"), F.count("*").alias("events"))


@query("validation_curve", over("b_misfits", """, t as (select iteration, sum(misfit) as total from b_misfits where event % 10 = 0 group by iteration)
select iteration, round(total / max(total) over (), 9) as normalised from t"""))
def validation_curve(spark, folder):
    t = tables.misfits(spark, folder).where(f"{ROLE} = 'validation'").groupBy("iteration").agg(F.sum("misfit").alias("total"))
    top = t.agg(F.max("total")).scalar()
    return t.select("iteration", rnd(F.col("total") / top, 9).alias("normalised")).orderBy("iteration")


@query("misfit_reduction", over("b_misfits", """, e as (select iteration, event, sum(misfit) as new from b_misfits group by iteration, event),
b as (select e.iteration, p.new as old, e.new from e join e p on e.event = p.event and e.iteration = p.iteration + 1),
t as (select iteration, sum(old) as old, sum(new) as new, count(*) as events from b group by iteration)
select iteration, events, round(100*(old-new)/old, 6) as percent, case when old > new then 'reduction' else 'increase' end as verdict from t"""))
def misfit_reduction(spark, folder):
    r = ledger.misfit_reduction(tables.misfits(spark, folder))
    return r.select("iteration", "events", rnd("percent", 6).alias("percent"), "verdict")


@query("job_status_counts", over("b_status", """select job_type, count(*) filter (where status = 'pending') as pending,
  count(*) filter (where status = 'running') as running, count(*) filter (where status = 'finished') as finished,
  count(*) filter (where status = 'failed') as failed, count(*) filter (where status = 'cancelled') as cancelled, count(*) filter (where status = 'unknown') as unknown,
  count(*) filter (where status not in ('pending', 'running', 'finished', 'failed', 'cancelled', 'unknown') or status is null) as other,
  bool_and(status = 'finished') as all_finished from (select * from b_status
  qualify row_number() over (partition by event, job_type order by ts desc, seq desc) = 1) group by job_type"""))
def job_status_counts(spark, folder):
    now = ledger.latest(tables.status(spark, folder), ["event", "job_type"], ["ts", "seq"])
    return ledger.status_counts(now, "job_type")


@query("latest_iteration", over("b_misfits", "select coalesce(max(iteration), 0) as iteration from b_misfits"))
def latest_iteration(spark, folder):
    return tables.misfits(spark, folder).agg(F.coalesce(F.max("iteration"), F.lit(0)).alias("iteration"))


@query("latest_task", over("b_status", "select event, job_type from b_status order by event desc, job_type desc limit 1"))
def latest_task(spark, folder):
    t = tables.status(spark, folder).agg(F.max(F.struct("event", "job_type")).alias("t"))
    return t.select("t.event", "t.job_type")


@query("event_ordinal", "select c_custkey as event, cast(row_number() over (order by c_custkey) - 1 as varchar) as ordinal from customer")
def event_ordinal(spark, folder):
    numbered = chunks.number_sorted(tables.pool(spark, folder).select("event"), ["event"], "ordinal")
    return numbered.select("event", F.col("ordinal").cast("string").alias("ordinal"))


@query("next_to_process", over("b_pool", SEEN + """select event, case when role = 'validation' then 0 when norm > 5000 then 1 else 2 end as priority
  from b_pool where event not in (select event from seen) order by 2, 1 limit 20"""))
def next_to_process(spark, folder):
    p = tables.pool(spark, folder).selectExpr("event", "case when role = 'validation' then 0 when norm > 5000 then 1 else 2 end as priority")
    return ledger.next_to_process(p, _seen(spark, folder), 20)


# ---- names ----------------------------------------------------------------


@query("iteration_name", over("b_misfits", "select distinct iteration, 'model_' || lpad(cast(iteration as varchar), 5, '0') as name, iteration as parsed from b_misfits"))
def iteration_name(spark, folder):
    i = tables.misfits(spark, folder).select("iteration").distinct().withColumn("name", names.iteration_name(F.col("iteration")))
    return i.withColumn("parsed", names.iteration_number(F.col("name")))


@query("strip_iteration_prefix", "select distinct o_orderpriority as name, o_orderpriority as stripped from orders union all select distinct 'ITERATION_' || o_orderpriority, o_orderpriority from orders")
def strip_iteration_prefix(spark, folder):
    p = tables.table(spark, folder, "orders").select(F.col("o_orderpriority").alias("p")).distinct()
    both = p.select(F.explode(F.array(F.col("p"), F.concat(F.lit("ITERATION_"), "p"))).alias("name"))
    return both.withColumn("stripped", names.strip_iteration_prefix(F.col("name")))


@query("processed_key", "select distinct p_size as min_period, 'preprocessed_' || p_size || 's_to_' || 2*p_size || 's' as key from part")
def processed_key(spark, folder):
    p = tables.table(spark, folder, "part").select(F.col("p_size").alias("min_period")).distinct()
    return p.withColumn("key", names.processed_key(F.col("min_period"), 2 * F.col("min_period")))


@query("split_trace_id", over("b_stations", """select station as id, cast(event as varchar) as network, cast(station as varchar) as station,
  'X.BHZ' as channel, event || '_' || station as flat from b_stations"""))
def split_trace_id(spark, folder):
    s = tables.stations(spark, folder).selectExpr("station as id", "concat_ws('.', event, station, 'X', 'BHZ') as trace_id", "concat_ws('.', event, station) as code")
    return s.select("id", *[c.alias(k) for k, c in names.split_trace_id(F.col("trace_id")).items()], names.flat_station(F.col("code")).alias("flat"))
