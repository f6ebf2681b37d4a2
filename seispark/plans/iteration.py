"""The resumable job of one inversion iteration."""

from pyspark.sql import functions as F

from seispark.operators import fields
from seispark.sources.stores import exists


def sum_and_merge(gradients, validation=None, pair=None, batch_average=False, keys=("param", "point")):
    """Summed gradient and per-event norms of the training events; ``pair`` names two parameters to merge."""
    training = gradients if validation is None else gradients.join(validation.select("event"), "event", "left_anti")
    total = fields.sum_over_events(training, keys, batch_average=batch_average)
    if pair is not None:
        total = fields.sum_two_params(total, pair, tuple(k for k in keys if k != "param"))
    return total, fields.event_norms(training)


class IterationJob:
    """norms -> averaging over the batch -> raw update -> smoothing -> model update, one folder per step.

    A step whose folder has its success marker is read, not run again, so a job
    that died goes on where it stopped, and no iteration carries the lineage of
    the ones before it.
    """

    def __init__(self, spark, path, rule, smoother=None, pair=None):
        """``smoother`` takes the raw update; ``pair`` names two parameters that share their gradient."""
        self.spark, self.path, self.rule, self.smoother, self.pair = spark, path, rule, smoother, pair

    def folder(self, iteration, step):
        return f"{self.path}/model_{iteration:05d}/{step}"

    def step(self, iteration, name, build):
        folder = self.folder(iteration, name)
        if not exists(self.spark, f"{folder}/_SUCCESS"):
            build().write.mode("overwrite").parquet(folder)
        return self.spark.read.parquet(folder)

    def start(self, model):
        """Keep the initial model (param, node, theta0, theta)."""
        return self.step(0, "model", lambda: model.select("param", "node", "theta0", "theta"))

    def norms(self, iteration):
        """(event, norm) of the gradients that an iteration used."""
        return self.spark.read.parquet(self.folder(iteration, "norms"))

    def run(self, iteration, gradients, validation=None):
        """``gradients``: (event, param, node, g) of the events of this iteration; returns the next model.

        Events in ``validation`` take no part. The gradient is the mean over the others, so that a step
        does not grow with the batch.
        """
        rule = self.rule
        mean, norms = sum_and_merge(gradients, validation, self.pair, batch_average=True, keys=("param", "node"))
        self.step(iteration, "norms", lambda: norms)
        theta0 = self.spark.read.parquet(self.folder(0, "model"))
        theta = self.spark.read.parquet(self.folder(iteration, "model"))
        previous = self.spark.read.parquet(self.folder(iteration - 1, "moments")) if iteration else None
        total = self.step(iteration, "gradient", lambda: mean.withColumnRenamed("value", "g"))
        moments = self.step(iteration, "moments", lambda: rule.moments(total, previous))
        raw = self.step(iteration, "raw_update", lambda: rule.raw_update(moments, iteration))
        smooth = self.step(iteration, "smooth_update", lambda: self.smoother(raw)) if self.smoother else None
        return self.step(
            iteration + 1, "model", lambda: rule.apply(raw, smooth, theta0, theta.select("param", "node", "theta"))
        )


def model_for_event(events, iteration, interval):
    """Name of the model each event is simulated on.

    Validation events take the average over the last ``interval`` iterations,
    except in iteration 0; all others take the current model.
    """
    current = F.format_string("model_%05d", F.lit(iteration))
    first = max(iteration - interval + 1, 0)
    average = F.format_string("average_%05d_%05d", F.lit(first), F.lit(iteration))
    use_average = (F.col("role") == "validation") & F.lit(iteration > 0)
    return events.withColumn("model", F.when(use_average, average).otherwise(current))
