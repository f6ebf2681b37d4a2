"""Range and nearest-neighbour jobs in space, on grid-cell keys."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seispark.functions import kernels
from seispark.functions.geo import squared_distance
from seispark.operators.chunks import spread
from seispark.operators.fourier import _lists as lists
from seispark.session import materialise

CELL = ["cx", "cy", "cz"]
#: Nodes that are worked on together, places of a part of a cell, and how many times ``HOME`` nodes are a part of a cell.
HOME, VISIT, TOGETHER = 128, 1024, 128
#: Binary digits of the fine cells along a side of a cell, and places that are worked on at a time.
FINE, AT_ONCE = 3, 2**16


def with_cell(points, size):
    return points.withColumns({c: F.floor(F.col(a) / size) for c, a in zip(CELL, "xyz")})


def near_cells(points, size):
    """Repeat each point in the 27 cells around it."""
    spread = with_cell(points, size)
    for c in CELL:
        spread = spread.withColumn(c, F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)))
    return spread


def _within(nodes, centres, radius):
    a = with_cell(nodes, radius).alias("a")
    b = near_cells(centres.select("x", "y", "z").distinct(), radius).alias("b")
    near = squared_distance({k: F.col(f"a.{k}") for k in "xyz"}, {k: F.col(f"b.{k}") for k in "xyz"}) < radius**2
    for c in CELL:
        near = near & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    return a, b, near


def nodes_within(nodes, centres, radius):
    """Nodes closer than ``radius`` to any centre, each once; a semi-join, so no pair is emitted."""
    a, b, near = _within(nodes, centres, radius)
    return a.join(b, near, "left_semi").drop(*CELL)


def cut_regions(nodes, centres, radius, value="value"):
    """All nodes, with ``value`` 0 where a centre is closer than ``radius``."""
    a, b, near = _within(nodes, centres, radius)
    inside = a.join(b, near, "left_semi").withColumn(value, F.lit(0.0))
    return inside.unionByName(a.join(b, near, "left_anti")).drop(*CELL)


def cut_own_source(nodes, sources, radius, value="value"):
    """Per event, ``value`` 0 at the nodes closer than ``radius`` to that event's source."""
    s = sources.select("event", *[F.col(k).alias(f"s{k}") for k in "xyz"])
    d2 = sum((F.col(k) - F.col(f"s{k}")) ** 2 for k in "xyz")
    joined = nodes.join(s, "event", "left")
    return joined.withColumn(value, F.when(d2 < radius**2, 0.0).otherwise(F.col(value))).drop("sx", "sy", "sz")


def nearest_nodes(targets, sources, k=4, by="layer", levels=24):
    """(node, source, d2, rank) of the k nearest sources of the same ``by`` value.

    One search, each target in cells of its own scale. Cells are halvings of the sources' box; the
    smallest one around the target (around the nearest place of the box, for a target outside) that holds
    k sources bounds the distance r of the k-th, and the k nearest then lie within R of that place, with
    R*R = r*r + 2*r*(distance to the box). The target meets the 27 cells of width R or more around it, so a dense
    cluster is searched finely and a target far away coarsely; nothing is left out. Of sources at one place only
    the k first ids can win, so copies are thinned to k before. The result is a written table, made to be used again.
    """
    place = Window.partitionBy(by, "x", "y", "z").orderBy("source")
    few = sources.withColumn("copy", F.row_number().over(place)).where(F.col("copy") <= k).drop("copy")
    few = materialise(few, "nearest-sources")
    box = few.agg(*[F.min(a).alias(f"lo{a}") for a in "xyz"], *[F.max(a).alias(f"hi{a}") for a in "xyz"]).first()
    low, high = ({a: box[f"{e}{a}"] or 0.0 for a in "xyz"} for e in ("lo", "hi"))
    unit = max(max(high[a] - low[a] for a in "xyz"), 1e-9) * (1 + 1e-9) / 2**levels
    fine = {c: F.floor((F.greatest(F.least(F.col(a), F.lit(high[a])), F.lit(low[a])) - low[a]) / unit).cast("bigint") for c, a in zip(CELL, "xyz")}
    every = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")

    def coarser(level):
        return {c: F.expr(f"shiftright({c}, {level})") for c in CELL}

    fine_sources = few.withColumns(fine)
    crowded = fine_sources.select(by, *CELL, every).withColumns(coarser("level")).groupBy(by, "level", *CELL).count().where(F.col("count") >= k)
    crowded = materialise(crowded.drop("count"), "nearest-cells")
    fine_targets = targets.select("node", by, "x", "y", "z").withColumns(fine)
    home = (
        fine_targets.select("node", by, *CELL, every).withColumns(coarser("level"))
        .join(crowded, [by, "level", *CELL], "left_semi").groupBy("node").agg(F.min("level").alias("level"))
    )
    outside = F.sqrt(sum((F.col(a) - F.greatest(F.least(F.col(a), F.lit(high[a])), F.lit(low[a]))) ** 2 for a in "xyz"))
    r = F.sqrt(F.lit(3.0)) * unit * F.pow(F.lit(2.0), F.col("level"))
    reach = F.sqrt(r * r + 2 * r * outside) * (1 + 1e-9)
    # fewer than k sources in the whole group: all of them are found at the coarsest level
    wide = F.least(F.greatest(F.ceil(F.log2(reach / unit)), F.lit(0)), F.lit(levels)).cast("int")
    at = fine_targets.join(home, "node", "left").withColumn("most", (outside + r) * (1 + 1e-9)).withColumn("level", F.when(F.col("level").isNull(), levels).otherwise(wide))
    at = materialise(at.withColumns(coarser("level")), "nearest-targets")
    for c in CELL:
        at = at.withColumn(c, F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)))
    used = at.agg(F.collect_set("level")).scalar()  # at most levels + 1 numbers
    b = fine_sources.withColumn("level", F.explode(used)).withColumns(coarser("level")).alias("b")
    same = F.lit(True)
    for c in [by, "level", *CELL]:
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    d2 = squared_distance({x: F.col(f"a.{x}") for x in "xyz"}, {x: F.col(f"b.{x}") for x in "xyz"})
    close = F.coalesce(d2 <= F.col("a.most") ** 2, F.lit(True))
    best = Window.partitionBy("node").orderBy("d2", "source")
    hits = at.alias("a").join(b, same & close).select("a.node", "b.source", d2.alias("d2"))
    return materialise(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "nearest")


def inverse_distance_weights(nearest):
    """(node, source, w): 1/d2, or the first exact hit alone; weights sum to 1 per node."""
    per_node = Window.partitionBy("node")
    exact = F.min("d2").over(per_node) == 0
    raw = F.when(exact, (F.col("rank") == 1).cast("double")).otherwise(1 / F.col("d2"))
    return nearest.withColumn("raw", raw).select(
        "node", "source", (F.col("raw") / F.sum("raw").over(per_node)).alias("w")
    )


def interpolate(weights, fields):
    """Values at the target nodes from (node, source, w) and fields (source, param, value)."""
    return weights.join(fields, "source").groupBy("node", "param").agg(F.sum(F.col("w") * F.col("value")).alias("value"))


def _home_parts(nodes, lateral, radial, min_period, velocity, by):
    """Nodes that are smoothed, packed by cell: (*by, size, cx, cy, cz, _part), an array for each of node, x, y, z, velocity and number of rows, and the box they reach.

    sigma = length * velocity * min_period per node. Cells are as wide as the node's own reach of three sigma, to
    the next power of two, so a fast region does not widen the search of a slow one. A part of a cell has about
    ``HOME * TOGETHER`` nodes. A node without a velocity above 0 or without a place has none. The parts are a written table.
    """
    reach = F.lit(3.0 * max(lateral, radial) * min_period) * F.col("v")
    width = F.pow(F.lit(2.0), F.ceil(F.log2(reach)))
    some = nodes.where((F.col(velocity) > 0) & ~F.isnan(velocity) & _placed())
    own = some.groupBy(*by, "node", *"xyz", F.col(velocity).cast("double").alias("v")).agg(F.count("*").alias("m"))
    own = _in_cells(own.withColumn("size", width))
    keys = [*by, "size", *CELL]
    box = [f(F.col(k) + sign * reach * (1 + 1e-9)).alias(f"{end}{k}") for end, f, sign in (("lo", F.min, -1), ("hi", F.max, 1)) for k in "xyz"]
    return materialise(_packed(_in_parts(own, keys, HOME * TOGETHER, ("node", *"xyz")), keys, ["node", *"xyz", "v", "m"], box), "home-parts")


def _placed():
    """Whether a row has a place: far from it are all others if a coordinate is no finite number."""
    return F.sqrt(sum(F.col(k) * F.col(k) for k in "xyz")) < float("inf")


def _in_cells(rows):
    return rows.withColumns({c: F.floor(F.col(k) / F.col("size")) for c, k in zip(CELL, "xyz")})


def _in_parts(rows, keys, most, dealt):
    """Rows with _part: the rows of a cell (``keys``) in parts of about ``most`` that lie together.

    A part goes on from one fine cell to the next one; a fine cell with more rows than a part is dealt to several.
    """
    digits = []
    for k, (c, x) in enumerate(zip(CELL, "xyz")):
        at = F.greatest(F.least(F.floor((F.col(x) / F.col("size") - F.col(c)) * 2**FINE), F.lit(2**FINE - 1)), F.lit(0))
        digits += [F.shiftleft(F.shiftright(at, d).bitwiseAND(F.lit(1)), 3 * d + k) for d in range(FINE)]
    rows = rows.withColumn("_fine", sum(digits))
    before = Window.partitionBy(*keys).orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_fine").agg(F.count("*").alias("_rows"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))  # at most 2^(3 FINE) rows of a cell
    # bounded memory whatever the rows of a key: no side is broadcast on a guess of its size
    own = rows.join(counts.hint("merge"), [*keys, "_fine"])
    place = F.col("_before") + F.pmod(F.xxhash64(*dealt), F.col("_rows"))
    return own.withColumn("_part", F.floor(place / most)).drop("_fine", "_rows", "_before")


def _packed(rows, keys, columns, more=()):
    """One row per part of a cell: an array for each of the columns."""
    packed = rows.groupBy(*keys, "_part").agg(F.collect_list(F.struct(*columns)).alias("p"), *more)
    return packed.select(*keys, "_part", *[F.col(f"p.{c}").alias(c) for c in columns], *[c for c in packed.columns if c not in (*keys, "_part", "p")])


def _visitors(home, places, by):
    """The places with the parts of cells they lie in, once for each width in use, and the parts of nodes that such a part visits; two written tables.

    A part visits the 27 cells around its own, of these the parts of nodes that reach its box.
    """
    keys = [*by, "size", *CELL]
    used = home.agg(F.sort_array(F.collect_set("size")).alias("sizes"))  # one number for each power of two in use
    at = _in_cells(places.where(_placed()).withColumn("size", F.explode(used.scalar())))
    at = materialise(_in_parts(at, keys, VISIT, tuple("xyz")), "visiting-places")
    boxes = at.groupBy(*keys, "_part").agg(*[f(k).alias(f"{end}{k}") for end, f in (("lo", F.min), ("hi", F.max)) for k in "xyz"])
    around = boxes.withColumnsRenamed({c: f"_{c}" for c in [*CELL, "_part"]})
    for c in CELL:
        around = around.withColumn(c, F.explode(F.array(F.col(f"_{c}") - 1, F.col(f"_{c}"), F.col(f"_{c}") + 1)))
    reached = home.select(*keys, "_part", *[F.col(f"{end}{k}").alias(f"_{end}{k}") for end in ("lo", "hi") for k in "xyz"])
    meets = around.join(reached.hint("merge"), keys)
    for k in "xyz":
        meets = meets.where((F.col(f"lo{k}") <= F.col(f"_hi{k}")) & (F.col(f"hi{k}") >= F.col(f"_lo{k}")))
    to = [F.col(c).alias(f"_to{c}") for c in [*CELL, "_part"]]
    meets = meets.select(*by, "size", *[F.col(f"_{c}").alias(c) for c in [*CELL, "_part"]], *to)
    return at, materialise(meets, "meetings")


def _gaussian_sums(home, places, meets, values, lateral, radial, min_period, by):
    """(*by, node, *values): sums of the values (null: zero) of the places within three sigma of a node, times their Gaussian weight.

    The radial and the lateral part of the distance are scaled by their own sigma. Only nodes and places with equal
    ``by`` meet. A part of the places of a cell goes to each part of nodes that it visits, which takes it in
    vectorised calls; no pair is a row. The nodes of a part are one row, and its visitors come behind it.
    The sums of a node come in a row for each of its places and velocities.
    """
    keys = [*by, "size", *CELL]
    filled = places.withColumns({v: F.coalesce(v, F.lit(0.0)) for v in values})
    visit = _packed(filled, keys, [*"xyz", *values]).join(meets.hint("merge"), [*keys, "_part"])
    nothing = {c: F.lit(None).cast(home.schema[c].dataType) for c in ("node", "v", "m")}
    visit = visit.select(*by, "size", *[F.col(f"_to{c}").alias(c) for c in [*CELL, "_part"]], F.lit(1).alias("_visits"), *"xyz", *values, *[x.alias(c) for c, x in nothing.items()])
    own = home.select(*keys, "_part", F.lit(0).alias("_visits"), *"xyz", *[F.lit(None).cast("array<double>").alias(v) for v in values], *nothing)
    # few bytes but much work: all tasks get some parts
    met = spread(own.unionByName(visit), *keys, "_part").sortWithinPartitions(*keys, "_part", "_visits")
    kept = [home.schema[c] for c in by] + [T.StructField("node", home.schema["node"].dataType.elementType)]
    schema = T.StructType(kept + [T.StructField(v, T.DoubleType()) for v in values])

    def work(batches):
        at = None  # the part of nodes at hand, and its visitors that are not yet summed up

        def add():
            if at["waiting"]:
                other = [np.concatenate(x) for x in zip(*at["waiting"])]
                kernels.gaussian_sums(at["own"], other, lateral * min_period, radial * min_period, at["sums"], at["met"], at["blocks"])
                at["waiting"].clear()

        def summed():
            add()
            nodes = at["node"].filter(pa.array(at["met"]))
            names = [at["head"].column(c).take(pa.array(np.zeros(len(nodes), np.int64))) for c in by]
            return pa.RecordBatch.from_arrays([*names, nodes, *[pa.array(x) for x in np.ascontiguousarray(at["sums"][at["met"]].T)]], schema.names)

        for batch in batches:
            visits = batch.column("_visits").to_pylist()
            own, other = ([lists(batch.column(c)) for c in names] for names in ([*"xyz", "v", "m"], [*"xyz", *values]))
            for row, visiting in enumerate(visits):
                if visiting:
                    at["waiting"].append([c[row] for c in other])
                    if sum(len(x[0]) for x in at["waiting"]) >= AT_ONCE:
                        add()
                    continue
                if at is not None:
                    yield summed()
                mine = [c[row].copy() for c in own]
                n = len(mine[0])
                at = {"own": mine, "node": batch.column("node")[row].values, "head": batch.select(by).slice(row, 1), "waiting": []}
                at |= {"sums": np.zeros((n, len(values))), "met": np.zeros(n, bool)}
                at["blocks"] = kernels.near_blocks(mine, lateral * min_period, radial * min_period, HOME)
        if at is not None:
            yield summed()

    return met.drop(*keys[len(by) :], "_part").mapInArrow(work, schema)


def smooth(nodes, lateral, radial, min_period, velocity="velocity", by=(), value="value"):
    """Gaussian mean of ``value`` over the nodes within three sigma: (*by, node, value).

    Nodes at the same place are merged before they meet others, and the
    pairs go straight into a partial sum. A node without a velocity above 0 keeps its value.
    """
    by = list(by)
    places = nodes.groupBy(*by, "x", "y", "z").agg(F.sum(value).cast("double").alias("_total"), F.count(value).cast("double").alias("_copies"))
    home = _home_parts(nodes, lateral, radial, min_period, velocity, by)
    sums = _gaussian_sums(home, *_visitors(home, places, by), ["_total", "_copies"], lateral, radial, min_period, by)
    mean = sums.groupBy(*by, "node").agg(F.try_divide(F.sum("_total"), F.sum("_copies")).alias("_mean"))
    return nodes.join(mean, [*by, "node"], "left").select(*by, "node", F.coalesce("_mean", value).alias(value))


def reference_velocities(params):
    """{parameter: velocity its smoothing lengths follow}: a velocity its own, all others VPV, else VP."""
    first = next((v for v in ("VPV", "VP") if v in params), None)
    if first is None and any(not p.startswith("V") for p in params):
        raise ValueError(f"none of {list(params)} is a P velocity")
    return {p: p if p.startswith("V") else first for p in params}


class ParameterSmoother:
    """Smooths updates (param, node, update) parameter by parameter, with one neighbour search for all of them.

    ``places`` has x, y, z of each node, ``model`` (param, node, velocity) the velocities that the smoothing lengths
    follow. Parameters that follow one velocity share their neighbours: the nodes of each velocity are written once in parts of cells, at
    the first update, and each update goes past the parts with all those parameters at a time. Weights are cheaper to
    compute again than to keep: they grow with the square of the nodes, the parts with the nodes.
    """

    def __init__(self, places, model, params, lateral, radial, min_period):
        self.follows = reference_velocities(params)
        self.places, self.lengths = places, (lateral, radial, min_period)
        speeds = model.where(F.col("param").isin(sorted(set(self.follows.values()))))
        self.nodes = speeds.select(F.col("param").alias("of"), "node", "velocity").join(places.select("node", "x", "y", "z").hint("merge"), "node")
        self.home = self.visiting = self.meets = None

    def search(self):
        """Writes the parts of nodes, the nodes as they visit other parts, and which parts they visit."""
        self.home = _home_parts(self.nodes, *self.lengths, "velocity", ["of"])
        self.visiting, self.meets = _visitors(self.home, self.nodes.drop("velocity"), ["of"])

    def __call__(self, update):
        if self.home is None:
            self.search()
        to = F.create_map(*[F.lit(x) for pair in self.follows.items() for x in pair])
        known = update.withColumn("of", to[F.col("param")]).join(self.visiting.hint("merge"), ["of", "node"])
        known = known.groupBy("of", "size", *CELL, "_part", *"xyz").agg(
            *[x for p in self.follows for own in (F.when(F.col("param") == p, F.col("update")),) for x in (F.sum(own).cast("double").alias(f"_s_{p}"), F.count(own).cast("double").alias(f"_n_{p}"))]
        )
        values = [f"_{k}_{p}" for p in self.follows for k in "sn"]
        sums = _gaussian_sums(self.home, known, self.meets, values, *self.lengths, ["of"])
        means = [F.try_divide(F.sum(f"_s_{p}"), F.sum(f"_n_{p}")).alias(p) for p in self.follows]
        mean = sums.groupBy("of", "node").agg(*means)
        both = F.explode(F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).alias("_mean")) for p in self.follows]))
        long = mean.select("node", "of", both.alias("m")).where(to[F.col("m.param")] == F.col("of")).select("m.param", "node", "m._mean")
        return update.join(long, ["param", "node"], "left").select("param", "node", F.coalesce("_mean", "update").alias("update"))


def smooth_parameters(update, places, model, params, lateral, radial, min_period):
    """An update (param, node, update) smoothed parameter by parameter, once; see ``ParameterSmoother``."""
    return ParameterSmoother(places, model, params, lateral, radial, min_period)(update)



def pair_summary(stations, tile=2048):
    """Per station: count, sum, least and largest angular distance to the others of its event, and proximity.

    ``proximity`` is the sum of 1/(1+distance) over all stations of the event,
    the station itself included. Every two stations have to meet, but no pair is
    written as a row: places are merged with their multiplicity, cut into tiles
    of bounded size, and two tiles meet in one vectorised call that returns sums
    per place. An event with very many stations is spread over its tiles.
    """
    places = materialise(stations.groupBy("event", "lat", "lon").agg(F.count("*").alias("m")), "places")
    sizes = places.groupBy("event").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    tiles = (
        places.join(sizes, "event")
        .withColumn("tile", F.pmod(F.xxhash64("lat", "lon"), F.col("tiles")))
        .groupBy("event", "tiles", "tile")
        .agg(F.sort_array(F.collect_list(F.struct("lat", "lon", "m"))).alias("p"))
        .select("event", "tiles", "tile", "p.lat", "p.lon", "p.m")
    )
    tiles = materialise(tiles, "tiles")
    mine = tiles.select(
        "event", F.explode(F.expr("sequence(0L, tiles - 1)")).alias("tile"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1")
    )
    met = spread(mine.join(tiles, ["event", "tile"]), "event", "tile", "lat1").select("event", "lat1", "lon1", "lat", "lon", "m")
    sums = met.select(
        "event", "lat1", "lon1", _tile_sums("lat1", "lon1", "lat", "lon", "m").alias("s")
    ).select("event", F.explode(F.arrays_zip("lat1", "lon1", "s")).alias("p"))
    per_place = sums.groupBy("event", F.col("p.lat1").alias("lat"), F.col("p.lon1").alias("lon")).agg(
        F.sum(F.col("p.s")[0]).alias("n_with_self"),
        F.sum(F.col("p.s")[1]).alias("sum_deg"),
        F.min(F.col("p.s")[2]).alias("near_other"),
        F.max(F.col("p.s")[3]).alias("max_deg"),
        F.sum(F.col("p.s")[4]).alias("proximity"),
    )
    full = places.join(per_place, ["event", "lat", "lon"]).select(
        "event", "lat", "lon",
        (F.col("n_with_self") - 1).cast("bigint").alias("n"), "sum_deg",
        F.when(F.col("m") > 1, 0.0).otherwise(F.col("near_other")).alias("min_deg"),
        "max_deg", "proximity",
    )
    return stations.join(full, ["event", "lat", "lon"])


@F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def _tile_sums(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series, m: pd.Series) -> pd.Series:
    out = []
    for a, b, c, d, count in zip(lat1, lon1, lat2, lon2, m):
        a, b, c, d = (np.radians(np.asarray(x, float)) for x in (a, b, c, d))
        count = np.asarray(count, float)
        cosine = np.outer(np.sin(a), np.sin(c)) + np.outer(np.cos(a), np.cos(c)) * np.cos(b[:, None] - d[None, :])
        deg = np.degrees(np.arccos(np.clip(cosine, -1, 1)))
        same = (a[:, None] == c[None, :]) & (b[:, None] == d[None, :])
        deg[same] = 0.0
        other = np.where(same, np.inf, deg).min(axis=1)
        out.append(
            np.stack(
                [np.full(len(a), count.sum()), deg @ count, other, deg.max(axis=1), (1 / (1 + deg)) @ count], axis=1
            ).tolist()
        )
    return pd.Series(out)


def station_weights(stations, tile=2048):
    """weight = 1/(proximity - 1), scaled so that the mean over an event's stations is 1.

    A station alone in its event has weight 1.
    """
    raw = pair_summary(stations, tile).withColumn(
        "raw", F.when(F.col("n") == 0, 1.0).otherwise(1 / (F.col("proximity") - 1))
    )
    total = raw.groupBy("event").agg((F.count("*") / F.sum("raw")).alias("scale"))
    return raw.join(total, "event").select("event", "station", (F.col("raw") * F.col("scale")).alias("weight"))
