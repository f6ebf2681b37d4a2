"""Nodal fields in long form: one row per (parameter, node)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.operators.quantiles import in_order, quantiles_of

# The parameter sets an inversion may use, each in its canonical order.
PARAMETER_ORDERS = [
    ["VP", "VS"],
    ["RHO", "VP", "VS"],
    ["VPV", "VPH", "VSV", "VSH"],
    ["VPV", "VPH", "VSV", "VSH", "RHO"],
    ["VPV", "VPH", "VSV", "VSH", "RHO", "QKAPPA", "QMU", "ETA"],
    ["QKAPPA", "QMU", "RHO", "VP", "VS"],
]


def arranged(parameters):
    """Array column of parameter names in canonical order; an unknown set raises an error."""
    same = [
        F.when(
            (F.size(F.array_except(parameters, F.array(*map(F.lit, order)))) == 0)
            & (F.size(F.array_except(F.array(*map(F.lit, order)), parameters)) == 0),
            F.array(*map(F.lit, order)),
        )
        for order in PARAMETER_ORDERS
    ]
    return F.coalesce(
        *same, F.raise_error(F.concat(F.lit("not a known parameter set: "), F.concat_ws(", ", parameters))).cast("array<string>")
    )


def parse_labels(label):
    """'[ A | B ]' -> array('A', 'B')."""
    return F.split(F.regexp_replace(label, r"[\[\] ]", ""), "[|]")


def join_labels(names):
    return F.concat(F.lit("[ "), F.concat_ws(" | ", names), F.lit(" ]"))


def select_params(nodal, wanted):
    """Rows of the wanted parameters only; a name the field does not have raises an error.

    The check is a one-row subquery over the parameter column alone.
    """
    names = F.array(*map(F.lit, wanted))
    present = nodal.agg(F.collect_set("param").alias("have")).select(
        F.size(F.array_except(names, F.col("have"))).alias("missing")
    )
    checked = F.assert_true(present.scalar() == 0, F.lit(f"not all of {wanted} are in the field"))
    return nodal.where(F.col("param").isin(wanted) & checked.isNull())


def replace_params(target, new, keys=("param", "node"), value="value"):
    """The target with the values of ``new`` where it has them; other parameters keep theirs."""
    fresh = new.select(*keys, F.col(value).alias("fresh"))
    return target.join(fresh, list(keys), "left").withColumn(value, F.coalesce("fresh", value)).drop("fresh")


def zero_fill(nodal, params):
    return nodal.withColumn("value", F.when(F.col("param").isin(params), 0.0).otherwise(F.col("value")))


def _is_field(mesh, name, kind):
    here = F.col("param") == name
    return here & (F.col("kind") == kind) if "kind" in mesh.columns else here


def have_fields(mesh, asked):
    """(kind, name, present) for each field asked for; a mesh has (kind, param, ...) rows.

    Kinds are nodal and elemental fields, side sets and global strings; a name of one kind is none of another.
    """
    have = mesh.select("kind", F.col("param").alias("name")).distinct().withColumn("_have", F.lit(True))
    return asked.join(have, ["kind", "name"], "left").select("kind", "name", F.coalesce("_have", F.lit(False)).alias("present"))


def copy_field(source, target, name, overwrite=True, kind="nodal"):
    """Add field ``name`` of the source mesh to the target; with overwrite off an existing one stays.

    Meshes with a ``kind`` column hold elemental fields, side sets and global strings beside nodal fields.
    """
    moved = source.where(_is_field(source, name, kind))
    if overwrite:
        return target.where(~_is_field(target, name, kind)).unionByName(moved)
    have = target.where(_is_field(target, name, kind)).select("param").limit(1)
    return target.unionByName(moved.join(have, "param", "left_anti"))


def region_of_interest(elements, is_fluid="fluid"):
    """Flag the layers from the one of the first fluid element on, layers counted from the largest id down."""
    first_fluid = elements.where(F.col(is_fluid)).agg(F.min_by("layer", "element")).scalar()
    return elements.withColumn("roi", F.coalesce(F.col("layer") <= first_fluid, F.lit(False)))


def sum_over_events(gradients, keys=("param", "point"), value="g", batch_average=False):
    combine = F.avg if batch_average else F.sum
    return gradients.groupBy(*keys).agg(combine(value).alias("value"))


def event_norms(gradients, value="g"):
    return gradients.groupBy("event").agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))


def sum_two_params(nodal, pair, keys=("point",), value="value"):
    """Both named parameters receive the sum of the two; keys hold one row per parameter."""
    p, q = pair
    both = F.sum(F.when(F.col("param").isin(p, q), F.col(value))).over(Window.partitionBy(*keys))
    return nodal.withColumn(value, F.when(F.col("param").isin(p, q), both).otherwise(F.col(value)))


def clip_quantile(nodal, percentile, by=("event", "param"), value="value"):
    """Clamp each parameter of each event's gradient to its [1-p, p] quantiles; p = 1 leaves it as it is."""
    if percentile == 1:
        return nodal
    rows = in_order(nodal, list(by), value)
    limits = quantiles_of(rows, list(by), value, {"low": 1 - percentile, "high": percentile})
    return (
        rows.drop("_pos").join(limits, list(by))
        .withColumn(value, F.greatest(F.least(F.col(value), F.col("high")), F.col("low")))
        .select(*nodal.columns)
    )


def average_models(models, first, last, keys=("param", "node"), value="value"):
    return models.where(F.col("iteration").between(first, last)).groupBy(*keys).agg(F.avg(value).alias(value))
