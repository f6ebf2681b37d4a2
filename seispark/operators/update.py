"""Model updates: Adam and stochastic gradient descent with momentum.

All tables are long: (param, node, ...). Global numbers (means, largest values,
norms) are one-row scalar subqueries, so an update is one lazy DataFrame.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

KEYS = ["param", "node"]


def join_moments(gradient, moments, names):
    """Gradient with the previous moments; 0 where there are none."""
    if moments is None:
        return gradient.withColumns({n: F.lit(0.0) for n in names})
    return gradient.join(moments.select(*KEYS, *names), KEYS, "left").withColumns(
        {n: F.coalesce(n, F.lit(0.0)) for n in names}
    )


def join_reference(model, initial):
    """theta beside theta0, only where theta0 is not 0."""
    return model.join(initial.where("theta0 <> 0").select(*KEYS, "theta0"), KEYS)


def relative_perturbation(theta, theta0):
    theta, theta0 = F.col(theta), F.col(theta0)
    return F.when(theta0 != 0, theta / theta0 - 1)


def guarded(df, column, bad, message):
    """The rows of df; a row for which ``bad`` holds stops the job."""
    return df.withColumn(column, F.when(bad, F.raise_error(F.lit(message))).otherwise(F.col(column)))


def too_large(column, limit):
    return F.abs(F.col(column)) > limit


def no_nan(df, column, what):
    """The rows of df; any NaN in ``column`` stops the job."""
    return guarded(df, column, F.isnan(column), f"NaN in {what}")


def check_magnitude(df, column, limit, what):
    """The rows of df; a value beyond ``limit`` stops the job."""
    return guarded(df, column, too_large(column, limit), f"{what} is larger than {limit}")


def verdicts(df, by, bad):
    """Per group of ``by`` how many rows a guard refuses and whether it lets all pass; refused rows do not stop the job here."""
    return df.groupBy(*by).agg(F.count(F.when(bad, 1)).alias("refused")).withColumn("accepted", F.col("refused") == 0)


def update_norms(raw, smooth, column="update"):
    """One row: largest value and norm of the raw and of the smoothed update."""

    def of(df, name):
        return df.agg(F.max(F.abs(column)).alias(f"max_{name}"), F.sqrt(F.sum(F.col(column) ** 2)).alias(f"norm_{name}"))

    a, b = of(raw, "raw"), of(smooth, "smooth")
    both = F.struct("max_raw", "norm_raw")
    return b.withColumn("r", a.select(both).scalar()).select("r.max_raw", "r.norm_raw", "max_smooth", "norm_smooth")


def _stepped(update, factor, theta0, theta, decay):
    """theta' from a scaled update, in perturbations relative to theta0; 0 where theta0 is 0."""
    joined = theta.join(theta0.select(*KEYS, "theta0"), KEYS).join(update.select(*KEYS, "update"), KEYS)
    before = relative_perturbation("theta", "theta0")
    after = before - F.col("update") * factor - decay * before
    return joined.select(
        *KEYS, "theta0", F.when(F.col("theta0") != 0, (after + 1) * F.col("theta0")).otherwise(0.0).alias("theta")
    )


@dataclass(frozen=True)
class Adam:
    """Adam with epsilon relative to the mean of the root second moment."""

    alpha: float = 0.001
    beta_1: float = 0.9
    beta_2: float = 0.999
    decay: float = 0.001
    epsilon: float = 0.1
    scaling: float = 1e17
    moment_names = ("m", "v")

    def moments(self, gradient, previous):
        g = no_nan(gradient, "g", "the gradient").withColumn("g", F.col("g") * self.scaling)
        state = join_moments(g, previous, self.moment_names)
        return state.select(
            *KEYS,
            (self.beta_1 * F.col("m") + (1 - self.beta_1) * F.col("g")).alias("m"),
            (self.beta_2 * F.col("v") + (1 - self.beta_2) * F.col("g") * F.col("g")).alias("v"),
        )

    def unchecked_update(self, moments, iteration):
        """Update from the moments of this iteration (numbered from 0), of any size."""
        k = iteration + 1
        root = F.sqrt(F.col("v") / (1 - self.beta_2**k))
        floor = F.lit(self.epsilon) * moments.agg(F.avg(root)).scalar()
        # a gradient of zeros everywhere has no scale and gives no step
        update = F.when(root + floor == 0, 0.0).otherwise(self.alpha * F.try_divide(F.col("m") / (1 - self.beta_1**k), root + floor))
        return moments.select(*KEYS, update.alias("update"))

    def raw_update(self, moments, iteration):
        """The update; NaN or a value beyond three times alpha stops the job."""
        raw = no_nan(self.unchecked_update(moments, iteration), "update", "the raw update")
        return check_magnitude(raw, "update", 3 * self.alpha, "the raw update")

    def apply(self, raw, smooth, theta0, theta):
        """New model; ``smooth`` is None where the update is not smoothed."""
        if smooth is None:
            return _stepped(raw, F.lit(1.0), theta0, theta, self.decay)
        smooth = check_magnitude(no_nan(smooth, "update", "the smoothed update"), "update", 4 * self.alpha, "the smoothed update")
        # an update of zeros is not scaled: the model changes by its decay alone
        factor = update_norms(raw, smooth).select(
            F.coalesce(
                F.least(
                    F.try_divide("norm_raw", "norm_smooth"),
                    F.try_divide(F.lit(self.alpha), "max_smooth"),
                    F.try_divide("max_raw", "max_smooth"),
                ),
                F.lit(0.0),
            )
        )
        return _stepped(smooth, factor.scalar(), theta0, theta, self.decay)


@dataclass(frozen=True)
class Momentum:
    """Gradient descent with one momentum term; the smoothed update is scaled to a largest step of alpha."""

    alpha: float = 0.001
    beta: float = 0.9
    decay: float = 0.001
    scaling: float = 1.0
    moment_names = ("v",)

    def moments(self, gradient, previous):
        g = no_nan(gradient, "g", "the gradient").withColumn("g", F.col("g") * self.scaling)
        state = join_moments(g, previous, self.moment_names)
        return state.select(*KEYS, (self.beta * F.col("v") + (1 - self.beta) * F.col("g")).alias("v"))

    def raw_update(self, moments, iteration):
        update = self.alpha * F.col("v") / (1 - self.beta ** (iteration + 1))
        return no_nan(moments.select(*KEYS, update.alias("update")), "update", "the raw update")

    def apply(self, raw, smooth, theta0, theta):
        update = no_nan(raw if smooth is None else smooth, "update", "the update")
        factor = update.agg(F.coalesce(F.try_divide(F.lit(self.alpha), F.max(F.abs("update"))), F.lit(0.0)))
        return _stepped(update, factor.scalar(), theta0, theta, (1 - self.beta) * self.decay)


OPTIMIZERS = {"adam": Adam, "sgd_with_momentum": Momentum}


def optimizer(name, **settings):
    """Update rule by name; any object with moments, raw_update and apply can be registered."""
    if name not in OPTIMIZERS:
        raise ValueError(f"no optimizer called {name}; known are {sorted(OPTIMIZERS)}")
    return OPTIMIZERS[name](**settings)
