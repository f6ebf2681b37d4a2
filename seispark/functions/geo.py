"""Geographic Column expressions."""

from pyspark.sql import functions as F

# WGS84 axes and the mean Earth radius, in metres.
AXIS_A = 6378137.0
AXIS_B = 6356752.314245
EARTH_RADIUS = 6371000.0


def geocentric_latitude(lat, axis_a=AXIS_A, axis_b=AXIS_B):
    """Elliptic to geocentric latitude in degrees; equator and poles unchanged."""
    lat = F.col(lat) if isinstance(lat, str) else lat
    fixed = (F.abs(lat) < 1e-6) | (F.abs(F.abs(lat) - 90) < 1e-6)
    e2 = (axis_a**2 - axis_b**2) / axis_a**2
    return F.when(fixed, lat).otherwise(F.degrees(F.atan((1 - e2) * F.tan(F.radians(lat)))))


def cartesian(lat, lon, depth_m=None):
    """x, y, z columns in metres on a sphere."""
    lat, lon = F.radians(lat), F.radians(lon)
    r = F.lit(EARTH_RADIUS) - (F.lit(0.0) if depth_m is None else F.col(depth_m))
    return {
        "x": r * F.cos(lat) * F.cos(lon),
        "y": r * F.cos(lat) * F.sin(lon),
        "z": r * F.sin(lat),
    }


def great_circle_degrees(lat1, lon1, lat2, lon2):
    """Angular distance; equal points are exactly 0."""
    p, q = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(p) * F.sin(q) + F.cos(p) * F.cos(q) * F.cos(F.radians(lon1) - F.radians(lon2))
    same = (F.col(lat1) == F.col(lat2)) & (F.col(lon1) == F.col(lon2))
    return F.when(same, 0.0).otherwise(F.degrees(F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))))


def squared_distance(a, b):
    x, y, z = (a[c] - b[c] for c in "xyz")
    return x * x + y * y + z * z


def with_geodesic_km(df, lat1, lon1, lat2, lon2, name="dist_km", rounds=10):
    """Vincenty inverse distance with a fixed number of rounds.

    Each round is one projection, so the intermediate values are computed once.
    Coincident points give 0; near-antipodal points may not have converged.
    """
    f = (AXIS_A - AXIS_B) / AXIS_A
    keep = df.columns

    def reduced(lat):
        return F.atan((1 - f) * F.tan(F.radians(lat)))

    step = df.select(
        *keep,
        reduced(lat1).alias("_u1"),
        reduced(lat2).alias("_u2"),
        (F.radians(lon2) - F.radians(lon1)).alias("_l"),
    )
    step = step.select(
        *keep, "_l", F.sin("_u1").alias("_su1"), F.cos("_u1").alias("_cu1"), F.sin("_u2").alias("_su2"),
        F.cos("_u2").alias("_cu2"), F.col("_l").alias("_lam"),
    )
    base = [*keep, "_l", "_su1", "_cu1", "_su2", "_cu2"]
    for _ in range(rounds):
        step = step.select(
            *base,
            "_lam",
            F.sqrt(
                (F.col("_cu2") * F.sin("_lam")) ** 2
                + (F.col("_cu1") * F.col("_su2") - F.col("_su1") * F.col("_cu2") * F.cos("_lam")) ** 2
            ).alias("_ss"),
            (F.col("_su1") * F.col("_su2") + F.col("_cu1") * F.col("_cu2") * F.cos("_lam")).alias("_cs"),
        )
        step = step.select(
            *base, "_ss", "_cs", F.atan2("_ss", "_cs").alias("_sig"),
            F.when(F.col("_ss") == 0, 0.0)
            .otherwise(F.col("_cu1") * F.col("_cu2") * F.sin("_lam") / F.col("_ss")).alias("_sa"),
        )
        step = step.withColumn("_c2", 1 - F.col("_sa") ** 2)
        step = step.withColumn(
            "_cm", F.when(F.col("_c2") == 0, 0.0).otherwise(F.col("_cs") - 2 * F.col("_su1") * F.col("_su2") / F.col("_c2"))
        ).withColumn("_c", f / 16 * F.col("_c2") * (4 + f * (4 - 3 * F.col("_c2"))))
        step = step.select(
            *base, "_ss", "_cs", "_sig", "_c2", "_cm",
            (
                F.col("_l")
                + (1 - F.col("_c")) * f * F.col("_sa")
                * (F.col("_sig") + F.col("_c") * F.col("_ss") * (F.col("_cm") + F.col("_c") * F.col("_cs") * (2 * F.col("_cm") ** 2 - 1)))
            ).alias("_lam"),
        )
    step = step.withColumn("_q", F.col("_c2") * (AXIS_A**2 - AXIS_B**2) / AXIS_B**2)
    step = step.withColumn(
        "_a", 1 + F.col("_q") / 16384 * (4096 + F.col("_q") * (-768 + F.col("_q") * (320 - 175 * F.col("_q"))))
    ).withColumn("_b", F.col("_q") / 1024 * (256 + F.col("_q") * (-128 + F.col("_q") * (74 - 47 * F.col("_q")))))
    delta = F.col("_b") * F.col("_ss") * (
        F.col("_cm")
        + F.col("_b") / 4 * (
            F.col("_cs") * (2 * F.col("_cm") ** 2 - 1)
            - F.col("_b") / 6 * F.col("_cm") * (4 * F.col("_ss") ** 2 - 3) * (4 * F.col("_cm") ** 2 - 3)
        )
    )
    return step.select(*keep, (AXIS_B * F.col("_a") * (F.col("_sig") - delta) / 1000).alias(name))
