"""Sampled functions as Columns."""

import math

from pyspark.sql import functions as F

from seispark.operators.chunks import index_rows


def gaussian_window(y, width):
    return (math.pi * width**2) ** -0.25 * F.exp(-0.5 * y * y / width**2)


def matlab_range(ranges):
    """Points start, start+step, ... of each row (trace, start, stop, step); the end counts if it is on the grid (1e-7)."""
    steps = "(stop - start) / step"
    count = f"if({steps} % 1 < 1e-7, round({steps}), ceil({steps}) - 1) + 1"
    return index_rows(ranges, count, "j").withColumn("x", F.col("start") + F.col("j") * F.col("step"))


def frequencies(dw):
    """Angular frequencies of periods 50 to 10."""
    low, high = 2 * math.pi / 50, 2 * math.pi / 10
    return [low + dw * k for k in range(int((high - low) / dw) + 1)]


def dispersed_wavetrain(t, distance, dw=0.001, a=4, b=1, c=1, body_factor=0.01, body_scale=0.5):
    """Surface-wave train of speed a - b*w - c*w*w at ``distance`` plus a body wave around t = 250."""
    t, d = F.col(t), F.col(distance)
    wave = F.lit(0.0)
    for w in frequencies(dw):
        wave = wave + F.lit(w) * F.cos(w * t - w * d / (a - b * w - c * w * w)) * dw
    return wave + body_factor * F.sin(body_scale * t) * F.exp(-((t - 250) ** 2) / 500.0)
