"""Full-batch gradient descent on mean-centred ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scores import clip_rating
from starloom.functions.vectors import dot
from starloom.operators.als import OTHER
from starloom.operators.factors import frobenius, start_factors, with_both
from starloom.sources.workspace import Workspace

# Ratings per bucket of a stored layout.
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 100_000


def biases(ratings: DataFrame, by: str = "user") -> DataFrame:
    return ratings.groupBy(by).agg(F.avg("rating").alias("bias"))


def centred(ratings: DataFrame, work: Workspace, by: str = "user") -> DataFrame:
    """Ratings minus the mean of their user (or item). The means are stored
    first: a join of two plain shuffles can split a very busy user. ``ratings``
    are read twice, so they should be stored."""
    with_bias = ratings.join(work.write(biases(ratings, by), "biases"), by)
    return with_bias.withColumn("rating", F.col("rating") - F.col("bias")).select(*ratings.columns)


class CentredRatings:
    """Centred ratings stored by the ids of each side, in buckets.

    The gradient of one side takes the ratings laid out by the other one: its
    vectors join them in place, and one shuffle by the own side brings the
    ratings to their sums. The given ratings are evaluated once.
    """

    def __init__(self, ratings: DataFrame, work: Workspace, by: str = "user"):
        self.work = work
        given = work.write(ratings.select("user", "item", "rating"), "given")
        cores = work.spark.sparkContext.defaultParallelism
        self.buckets = min(max(-(-given.count() // BUCKET_ROWS), cores), MAX_BUCKETS)
        self.rated = work.write_bucketed(given, "rated", by, self.buckets)
        work.discard("given")
        # Each bucket is centred where it lies.
        first = work.write_bucketed(centred(self.rated, work, by), f"centred-{by}", by, self.buckets, placed=True)
        self.n, self.sides = first.count(), {by: first}

    def by(self, key: str) -> DataFrame:
        """The ratings in buckets of one side's ids."""
        if key not in self.sides:
            self.sides[key] = self.work.write_bucketed(self.sides[OTHER[key]], f"centred-{key}", key, self.buckets)
        return self.sides[key]

    def step(self, users: DataFrame, items: DataFrame, key: str, rank: int, lam: float, rate: float) -> DataFrame:
        return gradient_step(self.by(OTHER[key]), users, items, key, rank, lam, rate, self.n)


def gradient_sums(ratings: DataFrame, users: DataFrame, items: DataFrame, key: str, rank: int) -> DataFrame:
    """Per id of one side what its gradient adds up, and its squared errors: one
    join, whose last shuffle is by that side and serves the sums, too."""
    theirs = "h" if key == "user" else "w"
    error = F.col("rating") - dot(F.col("w"), F.col("h"), rank)
    pull = [F.sum(error * F.col(theirs)[a]).alias(f"g{a}") for a in range(rank)]
    return with_both(ratings, users, items, last=key).groupBy(key).agg(*pull, F.sum(error * error).alias("sse"))


def moved(current: DataFrame, sums: DataFrame, key: str, rank: int, lam: float, rate: float, n_ratings: int) -> DataFrame:
    """The vectors of one side after a step; ids without ratings only shrink."""
    f = F.array(
        *[
            F.col("f")[a]
            - F.lit(rate)
            * (F.lit(lam) * F.col("f")[a] - F.coalesce(F.col(f"g{a}"), F.lit(0.0)) / F.lit(n_ratings))
            for a in range(rank)
        ]
    )
    return current.join(sums, key, "left").select(key, f.alias("f"))


def gradient_step(
    ratings: DataFrame,
    users: DataFrame,
    items: DataFrame,
    key: str,
    rank: int,
    lam: float,
    rate: float,
    n_ratings: int,
) -> DataFrame:
    """Move the vectors of one side against the gradient of the mean loss.
    The error part is k sums per id."""
    current = users if key == "user" else items
    return moved(current, gradient_sums(ratings, users, items, key, rank), key, rank, lam, rate, n_ratings)


def loss(
    ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int, lam: float, squared: bool = False
) -> DataFrame:
    """Half the mean squared error plus half of lam times the Frobenius norms
    (squared norms on request)."""
    error = F.col("rating") - dot(F.col("w"), F.col("h"), rank)
    data = with_both(ratings, users, items).agg((F.lit(0.5) * F.avg(error * error)).alias("data"))
    w = users.agg(frobenius(users, rank).alias("w"))
    h = items.agg(frobenius(items, rank).alias("h"))
    power = 2 if squared else 1
    penalty = F.lit(0.5 * lam) * (F.pow("w", F.lit(power)) + F.pow("h", F.lit(power)))
    one = [t.withColumn("one", F.lit(1)) for t in (data, w, h)]
    return one[0].join(one[1], "one").join(one[2], "one").select((F.col("data") + penalty).alias("loss"))


def predict_with_bias(
    pairs: DataFrame, users: DataFrame, items: DataFrame, bias: DataFrame, rank: int, by: str = "user"
) -> DataFrame:
    """Clipped prediction for pairs: product plus the bias, within the rating range."""
    score = dot(F.col("w"), F.col("h"), rank) + F.coalesce("bias", F.lit(0.0))
    w, h = users.select("user", F.col("f").alias("w")), items.select("item", F.col("f").alias("h"))
    # The bias travels with the vector of its side: no join of all pairs for it alone.
    if by == "user":
        w = w.join(bias, by, "left")
    else:
        h = h.join(bias, by, "left")
    return pairs.join(w, "user").join(h, "item").select(*pairs.columns, clip_rating(score).alias("score"))


def train_gradient(
    ratings: DataFrame,
    rank: int,
    lam: float,
    rate: float,
    iterations: int,
    work: Workspace,
    print_every: int = 1,
    by: str = "user",
) -> tuple[dict[str, DataFrame], list[tuple[int, float, float]]]:
    """Train; returns the factor tables, and (iteration, loss, RMSE) every
    ``print_every`` iterations."""
    if iterations < 1:
        raise ValueError("iterations must be at least 1")
    data = CentredRatings(ratings, work, by)
    n = data.n
    factors = {key: work.write(start_factors(data.by(key), key, rank), f"{key}-0") for key in OTHER}
    log = []

    def item_sums(iteration: int) -> DataFrame:
        """The sums of the next item step; their squared errors are the loss so far."""
        sums = gradient_sums(data.by("user"), factors["user"], factors["item"], "item", rank)
        return work.write(sums, f"sums-{iteration}")

    sums = item_sums(0)
    for iteration in range(1, iterations + 1):
        step = moved(factors["item"], sums, "item", rank, lam, rate, n)
        factors["item"] = work.write(step, f"item-{iteration}")
        step = data.step(factors["user"], factors["item"], "user", rank, lam, rate)
        factors["user"] = work.write(step, f"user-{iteration}")
        for old in (f"item-{iteration - 1}", f"user-{iteration - 1}", f"sums-{iteration - 1}"):
            work.discard(old)
        logged = iteration % print_every == 0
        if logged or iteration < iterations:
            sums = item_sums(iteration)
        if logged:
            mean = (sums.agg(F.sum("sse")).first()[0] or 0.0) / max(n, 1)
            norms = sum(t.agg(frobenius(t, rank)).first()[0] or 0.0 for t in factors.values())
            log.append((iteration, 0.5 * mean + 0.5 * lam * norms, mean**0.5))
    return factors, log
