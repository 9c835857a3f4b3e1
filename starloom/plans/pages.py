"""The query bundles behind the home and the detail page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.catalogue import first_items, items_of_genre, newest_items
from starloom.operators.factors import predict_pairs
from starloom.operators.ratings import item_profiles, rated_pairs, top_rated


def home(items: DataFrame, ratings: DataFrame, genre: str, more_than: int = 150, n: int = 12) -> DataFrame:
    """Four lists of the home page in one table (list, item, title). Each list
    holds n rows, so the union is tiny."""
    lists = {
        "first": first_items(items, n),
        "top": top_rated(ratings, items, more_than, n),
        "newest": newest_items(items, n),
        "genre": items_of_genre(items, genre, n),
    }
    out = None
    for name, table in lists.items():
        part = table.select(F.lit(name).alias("list"), "item", "title")
        out = part if out is None else out.unionByName(part)
    return out


def details(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """The item part of the detail page, for all items at once."""
    return item_profiles(items, ratings)


def own_view(pairs: DataFrame, ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """The user part of the detail page for a table of (user, item) pairs:
    the user's own rating, and the prediction (0 where there is none)."""
    own = rated_pairs(ratings, pairs).select("user", "item", F.col("rating").alias("own_rating"))
    return predict_pairs(pairs, users, items, rank).join(own, ["user", "item"], "left")
