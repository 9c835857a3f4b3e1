"""The registered queries: every operator on the sample tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import hashing, scores, text, vectors
from starloom.operators import als, best, blocks, catalogue, content, dsgd, factors, fuzzy, gradient, index, ratings, split
from starloom.plans import pages, training
from starloom.plans.shapes import Shapes, to_stream_ratings
from starloom.sources import readers, tables, writers
from starloom.sources.workspace import Workspace
from starloom.streaming import ratings as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Items of the sample data have 14 to 49 ratings.
ENOUGH = 30
GENRE = "widget"
LAM = 0.1
GD_LAM, GD_RATE = 0.05, 0.5
SGD_LAM, SGD_STEP, SGD_BLOCKS, SGD_SEED = 0.01, 0.005, 4, 1


def query(run: Callable[[Shapes, Workspace], DataFrame]) -> Callable:
    name = run.__name__

    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(Shapes(spark, folder), Workspace(spark, name))

    QUERIES[name] = call
    return run


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def spelled(table: DataFrame, key: str, rank: int = 2, digits: int = 4) -> DataFrame:
    """Factor vectors as one rounded column per component."""
    return table.select(key, *[F.round(F.col("f")[k], digits).alias(f"f{k}") for k in range(rank)])


# --- ratings ---------------------------------------------------------------


@query
def ratings_latest(t: Shapes, work: Workspace) -> DataFrame:
    return t.ratings


@query
def top_rated(t: Shapes, work: Workspace) -> DataFrame:
    best = ratings.top_rated(t.ratings, t.movies, ENOUGH)
    return rounded(best.select("item", "title", "genres", "n_ratings", "avg_rating"), 6, "avg_rating")


@query
def item_average(t: Shapes, work: Workspace) -> DataFrame:
    averages = ratings.item_averages(t.ratings)
    return averages.select("item", "n_ratings", scores.shown_average(F.col("avg_rating")).alias("shown"))


@query
def item_profile(t: Shapes, work: Workspace) -> DataFrame:
    profile = pages.details(t.dated_movies, t.ratings)
    return rounded(profile, 6, "average").withColumn("mpaa", scores.certificate(F.col("mpaa")))


@query
def star_histogram(t: Shapes, work: Workspace) -> DataFrame:
    return ratings.star_histogram(t.ratings)


@query
def rating_lookup(t: Shapes, work: Workspace) -> DataFrame:
    """The stored ratings of the pairs seen in the event log."""
    return ratings.rated_pairs(t.ratings, t.tags).select("user", "item", "rating")


@query
def user_items(t: Shapes, work: Workspace) -> DataFrame:
    """Every rating of the users seen in the event log."""
    return ratings.rated_by(t.ratings, "user", t.tags, work).select("user", "item", "rating")


@query
def rating_stats(t: Shapes, work: Workspace) -> DataFrame:
    return rounded(ratings.rating_stats(t.ratings), 6, "mean_rating")


# --- items and users ---------------------------------------------------------


@query
def first_items(t: Shapes, work: Workspace) -> DataFrame:
    return catalogue.first_items(t.movies)


@query
def newest_items(t: Shapes, work: Workspace) -> DataFrame:
    return catalogue.newest_items(t.dated_movies)


@query
def genre_filter(t: Shapes, work: Workspace) -> DataFrame:
    return catalogue.items_of_genre(t.movies, GENRE, n=None)


@query
def genre_members(t: Shapes, work: Workspace) -> DataFrame:
    return catalogue.items_of_genre(t.movies, GENRE, n=None, exact=True)


@query
def items_without_genres(t: Shapes, work: Workspace) -> DataFrame:
    """Movies joined to their links, the genres moved out to the bridge."""
    links = t.table("lineitem").groupBy(F.col("l_partkey").alias("item")).agg(F.min("l_suppkey").alias("tmdb_id"))
    items, genres = catalogue.without_genres(t.movies, links)
    counts = genres.groupBy("item").agg(F.count("*").alias("n_genres"))
    return items.join(counts, "item", "left")


@query
def title_lookup(t: Shapes, work: Workspace) -> DataFrame:
    return ratings.by_id(t.movies, "title", "red widget")


@query
def items_by_key(t: Shapes, work: Workspace) -> DataFrame:
    """Item rows for a key table: the items of the event log."""
    return ratings.rated_by(t.movies, "item", t.tags, work)


@query
def genre_bridge(t: Shapes, work: Workspace) -> DataFrame:
    return catalogue.bridge(t.movies, "genres", "genre")


@query
def attribute_bridges(t: Shapes, work: Workspace) -> DataFrame:
    """Genre and director bridges in one table; type and brand stand in for
    the directors."""
    directors = t.table("part").select(F.col("p_partkey").alias("item"), F.concat_ws("|", "p_type", "p_brand").alias("directors"))
    parts = [
        catalogue.bridge(t.movies, "genres", "value").withColumn("attribute", F.lit("genre")),
        catalogue.bridge(directors, "directors", "value").withColumn("attribute", F.lit("director")),
    ]
    return parts[0].unionByName(parts[1]).select("item", "attribute", "value")


@query
def struct_names(t: Shapes, work: Workspace) -> DataFrame:
    """Names out of an array of structs; a missing name becomes ''."""
    part = t.table("part")
    type_name = F.when(F.col("p_size") > 25, F.col("p_type"))
    genres = F.array(F.struct(F.col("p_name").alias("name")), F.struct(type_name.alias("name")))
    names = part.select(F.col("p_partkey").alias("item"), text.field_of(genres, "name").alias("names"))
    return names.select("item", text.join_list(F.col("names")).alias("names"))


@query
def home_bundle(t: Shapes, work: Workspace) -> DataFrame:
    return pages.home(t.dated_movies, t.ratings, GENRE, ENOUGH)


@query
def wide_items(t: Shapes, work: Workspace) -> DataFrame:
    movies = t.dated_movies
    part = t.table("part").select(F.col("p_partkey").alias("item"), "p_size", "p_type", "p_brand", "p_name")
    lines = t.table("lineitem")
    supplier = lines.groupBy(F.col("l_partkey").alias("item")).agg(F.min("l_suppkey").alias("tmdb_id"))
    links = supplier.select("item", F.concat(F.lit("tt"), F.col("item")).alias("imdb_id"), "tmdb_id", F.lit("link").alias("title"))
    primary = part.where("p_size <= 25").select(
        "item",
        F.concat_ws(" ", "p_name", "p_type").alias("plot"),
        F.lit(None).cast("string").alias("release_date"),
        F.concat(F.lit("/p/"), F.col("item")).alias("poster"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("mpaa"),
        F.array("p_type", "p_brand").alias("directors"),
        F.split("p_name", " ").alias("actors"),
    )
    first = lines.groupBy(F.col("l_partkey").alias("item")).agg(
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("release_date")
    )
    fallback = part.join(first, "item", "left").select(
        "item",
        F.col("p_name").alias("plot"),
        "release_date",
        F.lit(None).cast("string").alias("poster"),
        F.lit(None).cast("string").alias("mpaa"),
        F.lit(None).cast("array<string>").alias("directors"),
        F.split("p_name", " ").alias("actors"),
    )
    return catalogue.wide_items(movies.select("item", "title"), links, primary, fallback)


@query
def user_list(t: Shapes, work: Workspace) -> DataFrame:
    return catalogue.user_list(t.rating_events, t.tags)


@query
def users_matched(t: Shapes, work: Workspace) -> DataFrame:
    return catalogue.users_matched(t.rating_events, t.tags)


@query
def new_user_ids(t: Shapes, work: Workspace) -> DataFrame:
    """Customers' names registered as new users behind the existing raters."""
    names = t.table("customer").select(F.col("c_name").alias("username"))
    return catalogue.number_new_users(t.rating_events.select("user"), names, work)


# --- ids and splits ------------------------------------------------------------


@query
def dense_ids(t: Shapes, work: Workspace) -> DataFrame:
    users, _ = index.dense_ids(t.rating_events, "user", work)
    items, _ = index.dense_ids(t.rating_events, "item", work, start=0)
    return users.withColumn("side", F.lit("user")).unionByName(items.withColumn("side", F.lit("item")))


@query
def reindexed_ratings(t: Shapes, work: Workspace) -> DataFrame:
    dense, _, _ = training.preprocess(t.ratings, work)
    return dense


@query
def ids_back(t: Shapes, work: Workspace) -> DataFrame:
    """Dense ids of the raters mapped back over the ids of the event users:
    unmapped ids become 0."""
    dense, _, _ = training.preprocess(t.ratings.select("user", "item", "rating"), work)
    known, _ = index.dense_ids(t.tags, "user", work)
    per_user = dense.groupBy("user").agg(F.count("*").alias("n")).withColumn("dense", F.col("user"))
    return index.to_raw(per_user, "user", known, default=0).select("dense", "user", "n")


@query
def kfold(t: Shapes, work: Workspace) -> DataFrame:
    return split.folds(t.table("events").select("event_id"), ["event_id"], 5, work)


@query
def fold_invariants(t: Shapes, work: Workspace) -> DataFrame:
    """One row: the folds' union is the full set and no row is in two folds."""
    rows = split.folds(t.table("events").select("event_id"), ["event_id"], 5, work)
    per_row = rows.groupBy("event_id").agg(F.count("*").alias("n"), F.count_distinct("fold").alias("in_folds"))
    full = t.table("events").select("event_id")
    lost = full.join(rows, "event_id", "left_anti").agg(F.count("*").alias("lost"))
    sums = per_row.agg(
        F.sum("n").alias("n_union"), F.count("*").alias("n_ids"), F.count_if(F.col("in_folds") > 1).alias("n_shared")
    )
    return sums.withColumn("one", F.lit(1)).join(lost.withColumn("one", F.lit(1)), "one").drop("one")


@query
def holdout_per_user(t: Shapes, work: Workspace) -> DataFrame:
    """Rows 1-10 and 11-20 of every user in time order."""
    rows = t.table("events").select("event_id", F.col("user_id").alias("user"), "ts")
    placed = split.ordinal_in_user(rows, ["ts", "event_id"], work)
    return placed.select("event_id", F.col("k").between(1, 10).alias("in_a"), F.col("k").between(11, 20).alias("in_b"))


@query
def holdout_capped(t: Shapes, work: Workspace) -> DataFrame:
    """Rows 1-10 of every user, until 1000 rows are held out."""
    rows = t.table("events").select("event_id", F.col("user_id").alias("user"), "ts")
    return split.holdout(rows, ["ts", "event_id"], 1, 10, work, max_test=1000).select("event_id", "in_test")


@query
def first_ratings(t: Shapes, work: Workspace) -> DataFrame:
    """The first ten events of every user, by the pruned ranking."""
    rows = t.table("events").select("event_id", F.col("user_id").alias("user"), "ts")
    return split.first_rows_per_user(rows, ["ts", "event_id"], 10).select("event_id", "user", F.col("k").cast("bigint").alias("k"))


@query
def sorted_ratings(t: Shapes, work: Workspace) -> DataFrame:
    """Ratings numbered in (user, item) order: the distributed global sort."""
    ordered, _ = index.with_index(t.ratings.select("user", "item", "rating"), ["user", "item"], work, "sorted")
    return ordered


@query
def hash_split(t: Shapes, work: Workspace) -> DataFrame:
    return split.hash_split(t.ratings).select("user", "item", "in_train")


def _train_test(t: Shapes, work: Workspace) -> tuple[DataFrame, DataFrame]:
    parts = work.write(split.hash_split(t.ratings.select("user", "item", "rating")), "split")
    return parts.where("in_train").drop("in_train"), parts.where("not in_train").drop("in_train")


@query
def semi_filtered_test(t: Shapes, work: Workspace) -> DataFrame:
    """Test rows whose user and item both have train rows; the test set is
    the event log, the train set the ratings."""
    events = t.rating_stream_rows.select("event_id", "user", "item")
    return split.seen_in(events, _train_test(t, work)[0], work)


@query
def test_only_items(t: Shapes, work: Workspace) -> DataFrame:
    """Raters that never appear in the event log, as users."""
    return split.ids_only_in(t.rating_events, t.tags, "user")


@query
def cold_test_ids(t: Shapes, work: Workspace) -> DataFrame:
    """Users and items with test ratings that a split leaves without a train
    rating, for a small and the usual train share, and their ratings."""
    found = []
    for percent in (5, 80):
        parts = work.write(split.hash_split(t.ratings.select("user", "item", "rating"), percent), f"split-{percent}")
        train, test = parts.where("in_train"), parts.where("not in_train")
        for key in ("user", "item"):
            cold = work.write(split.ids_only_in(test, train, key), f"cold-{key}-{percent}")
            counts = test.join(cold, key, "left_semi").groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
            found.append(counts.select(F.lit(percent).cast("bigint").alias("percent"), F.lit(key).alias("side"), "id", "n"))
    return functools.reduce(DataFrame.unionByName, found)


@query
def unmapped_ids(t: Shapes, work: Workspace) -> DataFrame:
    """Dense ids of raters that have no raw id among the event users, with their ratings."""
    dense, _, _ = training.preprocess(t.ratings.select("user", "item", "rating"), work)
    known, _ = index.dense_ids(t.tags, "user", work)
    per_user = dense.groupBy("user").agg(F.count("*").alias("n")).withColumn("dense", F.col("user"))
    return index.to_raw(per_user, "user", known).where("user is null").select("dense", "n")


# --- factors --------------------------------------------------------------------


@query
def factor_init(t: Shapes, work: Workspace) -> DataFrame:
    return spelled(factors.start_factors(t.ratings, "user", 4), "user", 4, 8)


@query
def scaled_init(t: Shapes, work: Workspace) -> DataFrame:
    return spelled(factors.scaled_start_factors(t.ratings, "item", 4), "item", 4, 6)


@query
def implicit_init(t: Shapes, work: Workspace) -> DataFrame:
    return spelled(factors.implicit_start_factors(t.ratings, "item", 4), "item", 4, 9)


@query
def nan_check(t: Shapes, work: Workspace) -> DataFrame:
    """Vectors with a NaN: scaling by the logarithm of a component makes some."""
    spoiled = t.vectors.withColumn("f", F.transform("f", lambda x: F.when(x < -0.3, F.lit(float("nan"))).otherwise(x)))
    return spoiled.agg(F.count("*").alias("n"), vectors.nan_vectors(F.col("f")).alias("n_nan"))


@query
def dsgd_blocks(t: Shapes, work: Workspace) -> DataFrame:
    """Block of every user and item: 1-based ids, and the 0-based form."""
    users, n_users = index.dense_ids(t.ratings, "user", work)
    items, n_items = index.dense_ids(t.ratings, "item", work, start=0)
    u = users.withColumn("block", factors.block_of(F.col("dense_id"), n_users, 7)).withColumn("side", F.lit("user"))
    i = items.withColumn("block", factors.block_of(F.col("dense_id"), n_items, 7, 0)).withColumn("side", F.lit("item"))
    return u.unionByName(i)


@query
def dsgd_stratum(t: Shapes, work: Workspace) -> DataFrame:
    """Active ratings of one stratum per block under the schedule (2, 0, 3, 1)."""
    dense, users, items = training.preprocess(t.ratings.select("user", "item", "rating"), work)
    n_users, n_items = users.count(), items.count()
    laid = dense.withColumn("rb", factors.block_of(F.col("user"), n_users, 4)).withColumn(
        "cb", factors.block_of(F.col("item"), n_items, 4)
    )
    active = laid.where(factors.in_stratum(F.col("rb"), F.col("cb"), [2, 0, 3, 1]))
    return active.groupBy("rb", "cb").agg(F.count("*").alias("n"), F.sum("rating").alias("sum_rating"))


# --- least squares ----------------------------------------------------------------


def _half_step(t: Shapes, work: Workspace, route: str) -> DataFrame:
    run = als.AlsRun(t.ratings, 2, LAM, work, route=route)
    run.half_step("user")
    return spelled(run.factors["user"], "user")


@query
def als_half_step(t: Shapes, work: Workspace) -> DataFrame:
    return _half_step(t, work, "joined")


@query
def als_routed_step(t: Shapes, work: Workspace) -> DataFrame:
    return _half_step(t, work, "routed")


@query
def als_rank2_3iter(t: Shapes, work: Workspace) -> DataFrame:
    run, _ = als.train_als(t.ratings, 2, 3, LAM, work)
    users = spelled(run.factors["user"], "user").withColumnRenamed("user", "id").withColumn("side", F.lit("user"))
    items = spelled(run.factors["item"], "item").withColumnRenamed("item", "id").withColumn("side", F.lit("item"))
    return users.unionByName(items)


@query
def als_curve(t: Shapes, work: Workspace) -> DataFrame:
    train, test = _train_test(t, work)
    _, curve = als.train_als(train, 2, 3, LAM, work, test)
    return rounded(als.curve_table(t.spark, curve), 6, "train_rmse", "test_rmse")


@query
def als_rank10_rmse(t: Shapes, work: Workspace) -> DataFrame:
    _, curve = als.train_als(t.ratings, 10, 2, LAM, work)
    return rounded(als.curve_table(t.spark, curve).drop("test_rmse"), 6, "train_rmse")


@query
def dense_als_step(t: Shapes, work: Workspace) -> DataFrame:
    data = work.write(t.ratings.select("user", "item", "rating"), "ratings")
    items = work.write(factors.start_factors(data, "item", 2), "items")
    return spelled(als.dense_half_step(data, items, "user", 2, LAM), "user", 2, 6)


@query
def dense_als_rmse(t: Shapes, work: Workspace) -> DataFrame:
    """RMSE over all user-item cells, missing ones counted as 0."""
    data = work.write(t.ratings.select("user", "item", "rating"), "ratings")
    items = work.write(factors.start_factors(data, "item", 2), "items")
    users = work.write(als.dense_half_step(data, items, "user", 2, LAM), "users")
    value = als.dense_rmse(data, users, items, 2)
    return t.spark.createDataFrame([(round(value, 6),)], "rmse double")


@query
def pair_errors(t: Shapes, work: Workspace) -> DataFrame:
    """Squared error of every rating under the start factors."""
    data = work.write(t.ratings.select("user", "item", "rating"), "ratings")
    both = factors.with_both(data, factors.start_factors(data, "user", 2), factors.start_factors(data, "item", 2))
    error = vectors.squared_error(F.col("rating"), F.col("w"), F.col("h"), 2)
    return both.select("user", "item", F.round(error, 6).alias("error"))


# --- gradient descent ----------------------------------------------------------------


@query
def centred_ratings(t: Shapes, work: Workspace) -> DataFrame:
    by_user = gradient.centred(work.write(t.ratings.select("user", "item", "rating"), "ratings"), work)
    return rounded(by_user, 6, "rating")


def _gd(t: Shapes, work: Workspace, steps: tuple[str, ...]):
    data = gradient.CentredRatings(t.ratings, work)
    current = {k: work.write(factors.start_factors(data.by("user"), k, 2), f"{k}-0") for k in ("user", "item")}
    for key in steps:
        moved = data.step(current["user"], current["item"], key, 2, GD_LAM, GD_RATE)
        current[key] = work.write(moved, f"{key}-1")
    return data, current


@query
def gd_item_step(t: Shapes, work: Workspace) -> DataFrame:
    return spelled(_gd(t, work, ("item",))[1]["item"], "item", 2, 6)


@query
def gd_user_step(t: Shapes, work: Workspace) -> DataFrame:
    return spelled(_gd(t, work, ("item", "user"))[1]["user"], "user", 2, 6)


@query
def gd_loss(t: Shapes, work: Workspace) -> DataFrame:
    data, current = _gd(t, work, ("item", "user"))
    return rounded(gradient.loss(data.by("user"), current["user"], current["item"], 2, GD_LAM), 6, "loss")


@query
def gd_predict(t: Shapes, work: Workspace) -> DataFrame:
    data, current = _gd(t, work, ("item", "user"))
    predicted = gradient.predict_with_bias(
        data.rated.select("user", "item"), current["user"], current["item"], gradient.biases(data.rated), 2
    )
    return rounded(predicted, 4, "score")


@query
def gd_training(t: Shapes, work: Workspace) -> DataFrame:
    _, log = gradient.train_gradient(t.ratings, 2, GD_LAM, GD_RATE, 2, work)
    return rounded(t.spark.createDataFrame(log, "iteration bigint, loss double, rmse double"), 6, "loss", "rmse")


# --- stochastic gradient descent --------------------------------------------------


def _sgd(t: Shapes, work: Workspace, variant: str, cuts: str = "ids") -> DataFrame:
    run = dsgd.DsgdRun(t.ratings, 4, SGD_LAM, work, SGD_BLOCKS, variant=variant, cuts=cuts)
    run.epoch(SGD_STEP)
    return spelled(run.factors("user"), "user", 4, 6)


@query
def dsgd_epoch(t: Shapes, work: Workspace) -> DataFrame:
    return _sgd(t, work, "plain")


@query
def dsgd_weighted(t: Shapes, work: Workspace) -> DataFrame:
    return _sgd(t, work, "weighted")


@query
def dsgd_implicit(t: Shapes, work: Workspace) -> DataFrame:
    return _sgd(t, work, "implicit")


@query
def dsgd_balanced(t: Shapes, work: Workspace) -> DataFrame:
    """An epoch over blocks cut by ratings instead of ids."""
    return _sgd(t, work, "plain", "ratings")


@query
def dsgd_balanced_blocks(t: Shapes, work: Workspace) -> DataFrame:
    """Rating events per block when users and items are cut by their numbers of events."""
    dense, users, items = training.preprocess(t.rating_events.select("user", "item"), work)
    cuts = {}
    for key, ids in (("user", users), ("item", items)):
        counts = work.write(dense.groupBy(key).agg(F.count("*").alias("n")), f"weights-{key}")
        cuts[key] = dsgd.cuts_by_rating(counts, key, ids.count(), 7)
    laid = dense.select(
        factors.block_by_cuts(F.col("user"), cuts["user"]).cast("bigint").alias("rb"),
        factors.block_by_cuts(F.col("item"), cuts["item"]).cast("bigint").alias("cb"),
    )
    return laid.groupBy("rb", "cb").agg(F.count("*").alias("n"))


@query
def dsgd_curve(t: Shapes, work: Workspace) -> DataFrame:
    train, test = _train_test(t, work)
    _, curve = dsgd.train_dsgd(train, 4, 2, SGD_LAM, dsgd.decaying(SGD_STEP), work, test, SGD_BLOCKS)
    return rounded(als.curve_table(t.spark, curve), 6, "train_rmse", "test_rmse")


@query
def dsgd_shuffled(t: Shapes, work: Workspace) -> DataFrame:
    """Errors as strata are visited one an iteration in a shuffled order, with power-law steps."""
    train, test = _train_test(t, work)
    _, curve = dsgd.train_dsgd(
        train, 4, SGD_BLOCKS, SGD_LAM, dsgd.power_law(), work, test, SGD_BLOCKS, strata_per_iteration=1, seed=SGD_SEED
    )
    return rounded(als.curve_table(t.spark, curve), 6, "train_rmse", "test_rmse")


@query
def grid_metrics(t: Shapes, work: Workspace) -> DataFrame:
    """Two models on one split, one row per setting."""
    train, test = _train_test(t, work)
    runs = [training.Settings("als", rank, 2, lam) for lam in (0.1, 0.5) for rank in (2, 4)]
    runs.append(training.Settings("sgd", 4, 1, SGD_LAM, SGD_STEP, SGD_BLOCKS))
    metrics = training.grid(train, test, runs, "grid")
    writers.write_metrics(metrics, work.path("metrics"))
    return rounded(work.read(metrics, "metrics"), 6, "train_rmse", "test_rmse")


@query
def mllib_als(t: Shapes, work: Workspace) -> DataFrame:
    """Spark's own least squares, rank 10, on the ratings; mean squared error
    of its predictions joined back to them."""
    from pyspark.ml.recommendation import ALS

    data = work.write(t.ratings.select("user", "item", "rating"), "ratings")
    # Where its tables are kept, not what it computes: ratings and vectors on disk
    # rather than on the heap, messages until the next checkpoint (if a folder is set).
    kept = {"intermediateStorageLevel": "DISK_ONLY", "finalStorageLevel": "DISK_ONLY", "checkpointInterval": 2}
    model = ALS(
        rank=10, maxIter=10, seed=42, userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop", **kept
    ).fit(data)
    predicted = model.transform(data.select("user", "item")).select("user", "item", "prediction")
    both = data.join(predicted, ["user", "item"])
    mse = F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))
    return both.agg(F.count("*").alias("n"), F.round(mse, 3).alias("mse"))


# --- predictions -------------------------------------------------------------------


def _trained(t: Shapes, work: Workspace, iterations: int) -> als.AlsRun:
    run = als.AlsRun(t.ratings, 2, LAM, work)
    for _ in range(iterations):
        run.iterate()
    return run


@query
def predict_matrix(t: Shapes, work: Workspace) -> DataFrame:
    """All products of the 64-wide vectors with themselves."""
    v = t.vectors
    table = blocks.all_predictions(v.withColumnRenamed("id", "user"), v.withColumnRenamed("id", "item"), 64, work)
    return rounded(table, 5, "predict")


@query
def predict_point(t: Shapes, work: Workspace) -> DataFrame:
    """Predictions for the pairs of the event log; 0 for unknown ids."""
    run = _trained(t, work, 1)
    pairs = t.tags.select("user", "item").distinct()
    predicted = factors.predict_pairs(pairs, run.factors["user"], run.factors["item"], 2)
    return predicted.select("user", "item", F.round("score", 4).alias("score"), scores.shown_prediction(F.col("score")).alias("shown"))


@query
def detail_bundle(t: Shapes, work: Workspace) -> DataFrame:
    """Own rating and prediction for the pairs of the event log."""
    run = _trained(t, work, 1)
    pairs = t.tags.select("user", "item").distinct()
    return rounded(pages.own_view(pairs, run.train, run.factors["user"], run.factors["item"], 2), 4, "score")


@query
def top_n_user(t: Shapes, work: Workspace) -> DataFrame:
    run = _trained(t, work, 1)
    top = best.top_n_per_user(run.factors["user"], run.factors["item"], 2, 12, work)
    return rounded(top.select("user", "item", "predict", "rank"), 4, "predict")


@query
def top_n_unrated(t: Shapes, work: Workspace) -> DataFrame:
    run = _trained(t, work, 3)
    top = best.top_n_per_user(run.factors["user"], run.factors["item"], 2, 12, work, run.train)
    return rounded(top.select("user", "item", "predict", "rank"), 4, "predict")


@query
def recommended_items(t: Shapes, work: Workspace) -> DataFrame:
    """The best twelve of every user with their item rows, in rank order."""
    run = _trained(t, work, 1)
    top = best.top_n_per_user(run.factors["user"], run.factors["item"], 2, 12, work)
    return top.join(t.movies, "item", "left").select("user", "rank", "item", "title", "genres")


# --- content -------------------------------------------------------------------------


@query
def tfidf_weights(t: Shapes, work: Workspace) -> DataFrame:
    texts = t.table("documents").select(F.col("doc_id").alias("id"), "text")
    return rounded(content.tfidf_weights(texts, work), 6, "weight")


@query
def item_tfidf(t: Shapes, work: Workspace) -> DataFrame:
    return rounded(content.tfidf_weights(content.item_text(t.movies), work), 6, "weight")


@query
def similar_items(t: Shapes, work: Workspace) -> DataFrame:
    """The 59 most similar items of every item, itself included."""
    return content.similar_items(content.item_text(t.movies), 59, work, include_self=True)


@query
def similar_documents(t: Shapes, work: Workspace) -> DataFrame:
    texts = t.table("documents").select(F.col("doc_id").alias("id"), "text")
    return content.similar_items(texts, 10, work)


@query
def similar_vectors(t: Shapes, work: Workspace) -> DataFrame:
    return blocks.top_cosine(t.vectors, 64, 10, work)


def _misspelled(t: Shapes) -> DataFrame:
    return t.movies.select(F.regexp_replace("title", "e", "").alias("title"))


@query
def fuzzy_titles(t: Shapes, work: Workspace) -> DataFrame:
    return fuzzy.close_titles(_misspelled(t), t.movies, work)


@query
def similar_to_title(t: Shapes, work: Workspace) -> DataFrame:
    """Items similar to the item a misspelled title stands for."""
    similar = content.similar_items(content.item_text(t.movies), 12, work)
    return fuzzy.similar_to_titles(_misspelled(t), t.movies, similar, work)


# --- sources, sinks, layouts ---------------------------------------------------------


@query
def partitioned_by_date(t: Shapes, work: Workspace) -> DataFrame:
    events = t.table("events").select("event_id", "ts", "value")
    stored = tables.partition_by_date(events, "ts", work.path("by-day"))
    return stored.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.round(F.sum("value"), 2).alias("sum_value")
    )


@query
def trips_by_type(t: Shapes, work: Workspace) -> DataFrame:
    """Events as trips, partitioned by the time column of their type."""
    trips = t.table("events").select("event_id", F.col("ts").alias(tables.TIME_COLUMN["green"]))
    stored = tables.partition_trips(trips, "green", work.path("green"))
    return stored.select("event_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query
def monthly_source_name(t: Shapes, work: Workspace) -> DataFrame:
    days = t.table("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        tables.source_month(F.col("day")).alias("dashed"),
        tables.source_month(F.col("day"), "_").alias("underscored"),
    )


@query
def type_union(t: Shapes, work: Workspace) -> DataFrame:
    """Raw files of two types; all files of one type land under its folder."""
    events = t.table("events").select("event_id", "event_type", "value")
    raw = work.path("raw")
    clicks = events.where("event_type = 'click'")
    clicks.where("value < 10").write.parquet(f"{raw}/click_low")
    clicks.where("value >= 10").write.parquet(f"{raw}/click_high")
    events.where("event_type = 'view'").write.parquet(f"{raw}/view_all")
    return tables.land_by_type(t.spark, raw, "click", work.path("landed"))


def _as_file_rows(rows: DataFrame) -> DataFrame:
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return rows.select(F.col("user").alias("userId"), F.col("item").alias("movieId"), "rating", seconds.alias("timestamp"))


@query
def csv_round_trip(t: Shapes, work: Workspace) -> DataFrame:
    writers.write_csv(_as_file_rows(t.ratings), work.path("csv"))
    back = readers.read_ratings(t.spark, work.path("csv"))
    return back.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query
def tab_round_trip(t: Shapes, work: Workspace) -> DataFrame:
    writers.write_csv(_as_file_rows(t.ratings), work.path("tab"), sep="\t", header=False)
    back = readers.read_tab_ratings(t.spark, work.path("tab"))
    return back.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query
def bad_rows(t: Shapes, work: Workspace) -> DataFrame:
    """A file whose rating column holds text in some rows: those are reported."""
    rows = t.table("orders").select(
        F.col("o_custkey").alias("userId"), F.col("o_orderkey").alias("movieId"),
        F.when(F.col("o_orderstatus") == "P", F.lit("none")).otherwise(F.lit("3.5")).alias("rating"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
    )
    writers.write_csv(rows, work.path("csv"))
    read = readers.read_delimited(t.spark, work.path("csv"), readers.RATING_FILE, keep_bad_rows=True)
    good, bad = readers.split_bad_rows(work.write(read, "read"))
    counts = good.agg(F.count("*").alias("good"), F.sum("rating").alias("sum_rating")).withColumn("one", F.lit(1))
    return counts.join(bad.agg(F.count("*").alias("bad")).withColumn("one", F.lit(1)), "one").drop("one")


@query
def dimension_round_trip(t: Shapes, work: Workspace) -> DataFrame:
    """Users with demographics through a pipe-separated file; zip stays text."""
    users = t.table("customer").join(
        t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey"
    ).select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("age"), F.substring("n_name", 1, 1).alias("gender"),
        F.col("c_mktsegment").alias("occupation"), F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("zip"),
    )
    writers.write_csv(users, work.path("users"), sep="|", header=False)
    back = readers.read_dimension(t.spark, work.path("users"), readers.USER_FILE)
    return back.withColumn("age", F.col("age").cast("bigint"))


@query
def implicit_pairs(t: Shapes, work: Workspace) -> DataFrame:
    writers.write_csv(t.rating_events.select(F.col("user") + 1, F.col("item") + 1), work.path("pairs"), header=False)
    return readers.read_implicit_pairs(t.spark, work.path("pairs"), partitions=8)


@query
def parquet_to_csv(t: Shapes, work: Workspace) -> DataFrame:
    writers.parquet_to_csv(t.spark, f"{t.folder}/supplier.parquet", work.path("csv"))
    schema = "s_suppkey BIGINT, s_name STRING, s_nationkey BIGINT, s_acctbal DOUBLE"
    return readers.read_delimited(t.spark, work.path("csv"), schema)


@query
def timestamp_load(t: Shapes, work: Workspace) -> DataFrame:
    """Text timestamps parsed on load: a first load and one increment."""
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("pickup"),
        F.date_format(F.date_add("l_shipdate", 1), "yyyy-MM-dd HH:mm:ss").alias("dropoff"), "l_returnflag",
    )
    columns = ["pickup", "dropoff"]
    writers.load_timestamped(lines.where("l_returnflag <> 'R'"), columns, work.path("trips"))
    writers.load_timestamped(lines.where("l_returnflag = 'R'"), columns, work.path("trips"), mode="append")
    return t.spark.read.parquet(work.path("trips")).groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.date_format(F.min("pickup"), "yyyy-MM-dd").alias("first_pickup"),
        F.date_format(F.max("dropoff"), "yyyy-MM-dd").alias("last_dropoff"),
    )


@query
def json_factor_round_trip(t: Shapes, work: Workspace) -> DataFrame:
    writers.write_factors(t.vectors, "id", "user", work.path("user_matrix"))
    back = readers.read_json_lines(t.spark, f"{work.path('user_matrix')}/*", readers.USER_FACTOR_FILE)
    total = F.aggregate("array", F.lit(0.0), lambda s, x: s + x)
    return back.select("user", F.size("array").cast("bigint").alias("width"), F.round(total, 5).alias("total"))


@query
def json_document(t: Shapes, work: Workspace) -> DataFrame:
    """A dictionary through one JSON object: the order count per nation."""
    counts = t.table("customer").groupBy(F.col("c_nationkey").alias("key")).agg(F.count("*").alias("value"))
    writers.write_json_document(counts, work.path("document"))
    return readers.read_json_document(t.spark, work.path("document"), "BIGINT")


@query
def run_snapshot(t: Shapes, work: Workspace) -> DataFrame:
    """A table written under its run and published as the latest."""
    run = tables.RunFolder(t.spark, work.path("runs"), "2024-01-28")
    run.write(t.ratings.select("user", "item", "rating"), "processed", "ratings")
    run.publish("processed", "ratings")
    return run.latest("ratings")


@query
def external_table(t: Shapes, work: Workspace) -> DataFrame:
    """A CSV file of predictions registered as a table and read by SQL."""
    v = t.vectors
    product = blocks.all_predictions(v.withColumnRenamed("id", "user"), v.withColumnRenamed("id", "item"), 64, work)
    writers.write_predictions(
        product.select("user", F.col("item").alias("movie"), F.round("predict", 5).alias("predict")), work.path("predictions")
    )
    name = f"predictions_{uuid4().hex}"
    tables.external_table(t.spark, name, "csv", work.path("predictions"), readers.PREDICTION_FILE)
    return t.spark.sql(f"SELECT user, count(*) AS n, round(max(predict), 4) AS best FROM {name} GROUP BY user")


@query
def prediction_buckets(t: Shapes, work: Workspace) -> DataFrame:
    """Top-12 predictions stored in folders by user; each user's rows read back."""
    run = _trained(t, work, 1)
    top = best.top_n_per_user(run.factors["user"], run.factors["item"], 2, 12, work)
    writers.write_predictions(top.select("user", F.col("item").alias("movie"), "predict"), work.path("buckets"), "parquet", 8)
    stored = t.spark.read.parquet(work.path("buckets"))
    return stored.groupBy("user").agg(F.count("*").alias("n"), F.round(F.max("predict"), 4).alias("best"))


@query
def replaced_table(t: Shapes, work: Workspace) -> DataFrame:
    """A relational table replaced, extended, and read by column."""
    name = f"users_{uuid4().hex}"
    users = catalogue.user_list(t.rating_events, t.tags)
    writers.replace_table(t.movies, name, work.path("table"))
    writers.replace_table(users, name, work.path("table"))
    writers.append_table(users, name)
    return readers.read_table(t.spark, name, ["username"])


@query
def synthetic_ratings(t: Shapes, work: Workspace) -> DataFrame:
    return readers.synthetic_ratings(t.spark, t.table("events"), "event_id")


# --- whole runs and streams ------------------------------------------------------------


@query
def end_to_end_run(t: Shapes, work: Workspace) -> DataFrame:
    """Re-index, train three iterations, map back, predict all pairs, publish:
    the published predictions summed up per user."""
    settings = training.Settings("als", 2, 3, LAM)
    run = training.run_all(t.spark, t.ratings, settings, work.path("runs"), "2024-01-28")
    return run.latest("predictions").groupBy("user").agg(
        F.count("*").alias("n"), F.round(F.avg("predict"), 4).alias("mean"), F.round(F.max("predict"), 4).alias("best")
    )


@query
def train_job(t: Shapes, work: Workspace) -> DataFrame:
    """The training front: split, train, factor files; the files read back."""
    model = training.train_job(t.ratings, training.Settings("als", 2, 2, LAM), work.path("model"), work)
    back = readers.read_json_lines(t.spark, f"{work.path('model')}/movie_matrix/*", readers.ITEM_FACTOR_FILE)
    return back.select("movie", F.round(F.col("array")[0], 4).alias("f0"), F.round(F.col("array")[1], 4).alias("f1"),
                       F.lit(round(model.test_rmse, 6)).alias("test_rmse"))


def _event_files(t: Shapes, work: Workspace, name: str):
    """The event log as four files, so that a drained stream has four batches."""
    log = t.table("events")
    log.repartition(4, "event_id").write.parquet(work.path(name))
    return log.schema, work.path(name)


@query
def stream_upsert(t: Shapes, work: Workspace) -> DataFrame:
    schema, path = _event_files(t, work, "events")
    events = to_stream_ratings(stream.read_event_stream(t.spark, path, schema, 1))
    log = stream.RatingLog(t.spark, work.path("log"))
    stream.upsert_stream(events, log, work.path("checkpoint")).awaitTermination()
    final = log.compact(work.path("compacted")).current()
    return final.select("user", "item", "rating", "event_id")


@query
def stream_item_stats(t: Shapes, work: Workspace) -> DataFrame:
    schema, path = _event_files(t, work, "events")
    events = to_stream_ratings(stream.read_event_stream(t.spark, path, schema, 1))
    stream.item_stats_stream(events, work.path("stats"), work.path("checkpoint")).awaitTermination()
    return rounded(stream.current_item_stats(t.spark, work.path("stats")), 2, "sum_rating")


def _stored_ratings(t: Shapes) -> DataFrame:
    stored = t.ratings.select("user", "item", "rating", F.col("ts").cast("timestamp").alias("ts"))
    return stored.withColumn("event_id", F.lit(-1).cast("bigint"))


@query
def stream_updated_items(t: Shapes, work: Workspace) -> DataFrame:
    """Item figures over the stored ratings as the event ratings update them."""
    schema, path = _event_files(t, work, "events")
    events = to_stream_ratings(stream.read_event_stream(t.spark, path, schema, 1))
    ledger = stream.RatingLedger.begin(_stored_ratings(t), work.path("ledger"))
    stream.upsert_stream(events, ledger, work.path("checkpoint")).awaitTermination()
    return rounded(ledger.item_stats(), 2, "sum_rating")


@query
def tag_round_trip(t: Shapes, work: Workspace) -> DataFrame:
    """Tags through their CSV file: columns renamed, epoch seconds as time."""
    tags = t.tags.select(
        F.col("user").alias("userId"), F.col("item").alias("movieId"), "tag", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp")
    )
    writers.write_csv(tags, work.path("tags"))
    return readers.read_tags(t.spark, work.path("tags")).select("user", "item", "tag", F.unix_timestamp("ts").alias("seconds"))


@query
def rating_upsert(t: Shapes, work: Workspace) -> DataFrame:
    """The event ratings merged into the stored ones; newest per pair wins."""
    stored = _stored_ratings(t)
    return ratings.upsert(stored, t.rating_stream_rows, "ts", "event_id").select("user", "item", "rating", "event_id")


@query
def rating_append(t: Shapes, work: Workspace) -> DataFrame:
    """Event ratings added to the rating events, without replacing any."""
    both = ratings.append(t.rating_events.select("user", "item", "rating"), t.rating_stream_rows.select("user", "item", "rating"))
    return both.groupBy("user").agg(F.count("*").alias("n"), F.round(F.sum("rating"), 2).alias("sum_rating"))


__all__ = ["QUERIES", "hashing"]
