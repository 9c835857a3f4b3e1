"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors with equal labels are compared. A vector is a member of the shards of
its two nearest centres, so the cluster shards overlap. In every shard a flat
graph of the members is built: each keeps near ones as neighbours, but none that
a kept one already leads to (robust pruning); the medoid leads to every part of
the graph. The adjacency lists of all shards are united.

Every vector then searches its shards: from the medoid, and from itself where it
is a member, to the best vectors not yet opened, and once vectors in range turn
up, on through all vectors in range until none is left unopened. Cosines are
computed for vectors that a search reaches. Besides its two shards a vector
searches those of every centre whose border with its nearest one is at most half
the range angle away. A path between vectors of two clusters crosses their
border, hence one end of a pair in range lies that near to it and searches the
other's nearest shard. A pair counts once: in the nearest shard of one end, the
smaller of the two where both ends search the other's. Pairs are confirmed in
double precision. Centres in range of a fuller one are dropped, so a group of
near copies is not cut up. ``audit_recall`` compares with brute force;
``exact=True`` adds what a search missed by block products within the shards.

Equal vectors are one node, whatever their number. Members of a shard beyond
``PIECE`` are cut into pieces with a graph each, searchers beyond ``SEARCHERS``
likewise, and every piece of searchers meets every piece of members, so a task
holds one of each; only counts and spanning links leave the task, never all
pairs. Centres are fitted on at most ``SAMPLE`` vectors in all, the smallest by
hash; all vectors are indexed and searched.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those without a label, link with nothing; vectors of unequal
length never link; repeated rows are copies; null ids name no component; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import components, digest, frugal
from starloom.sources.workspace import Workspace

COSINE = 0.98
SAMPLE = 65_536
SHARD = 512
PIECE = 2048
SEARCHERS = 4096
MAX_CENTRES = 8192
DEGREE = 24
ALPHA = 1.2
# A search opens the unopened among the BEAM best seen, OPENED at a time.
BEAM = 32
OPENED = 8
# What single precision may lose of a cosine.
SLACK = 1e-5


def unit(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def pruned(units: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Adjacency lists [n, degree] by robust pruning, -1 where a list is shorter."""
    n = len(units)
    out = np.full((n, degree), -1, np.int64)
    pool = min(n - 1, 3 * degree)
    if pool < 1:
        return out
    for at in range(0, n, 256):
        rows = np.arange(at, min(at + 256, n))
        near = units[rows] @ units.T
        near[np.arange(len(rows)), rows] = -np.inf
        cand = np.argpartition(-near, pool - 1, axis=1)[:, :pool]
        cosine = np.take_along_axis(near, cand, axis=1)
        order = np.argsort(-cosine, axis=1, kind="stable")
        cand, cosine = np.take_along_axis(cand, order, axis=1), np.take_along_axis(cosine, order, axis=1)
        away = 2 - 2 * cosine
        between = units[cand]
        between = 2 - 2 * (between @ between.transpose(0, 2, 1))
        alive = np.ones(cand.shape, bool)
        for k in range(degree):
            first = alive.argmax(axis=1)
            some = np.flatnonzero(alive[np.arange(len(rows)), first])
            if not len(some):
                break
            out[rows[some], k] = cand[some, first[some]]
            alive[some] &= alpha * alpha * between[some, first[some]] > away[some]
            alive[some, first[some]] = False
    return out


def connected(units: np.ndarray, graph: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of the adjacency lists in both directions, and of the medoid
    to the nearest vector of every part that it does not reach."""
    a, k = np.nonzero(graph >= 0)
    b = graph[a, k]
    one, two = np.concatenate((a, b)), np.concatenate((b, a))
    part = np.arange(len(units))
    while True:
        low = part.copy()
        np.minimum.at(low, one, part[two])
        low = low[low]
        if (low == part).all():
            break
        part = low
    value = units @ units[medoid_of(units)]
    order = np.lexsort((-value, part))
    first = order[np.concatenate(([True], part[order][1:] != part[order][:-1]))]
    first = first[part[first] != part[medoid_of(units)]]
    middle = np.full(len(first), medoid_of(units))
    return np.concatenate((one, first, middle)), np.concatenate((two, middle, first))


def medoid_of(units: np.ndarray) -> int:
    return int((units @ units.sum(axis=0)).argmax())


def search(
    units: np.ndarray,
    graph: tuple[np.ndarray, np.ndarray],
    start: int,
    queries: np.ndarray,
    own: np.ndarray,
    in_range: float,
    beam: int = BEAM,
) -> np.ndarray:
    """Cosines [query, vector] of the vectors each query reaches, -inf elsewhere.

    ``graph`` holds the bounds of each vector's neighbours and the neighbours
    in a row; ``own`` is a query's place among the vectors, or -1. All queries
    step together, each from ``start`` and from itself. A step opens the best
    few unopened vectors among the ``beam`` best reached, and all unopened ones
    in range, and reaches their neighbours. Where most of them are new their
    cosines are computed as a block, else one by one.
    """
    bounds, flat = graph
    n, q = len(units), len(queries)
    degree = np.diff(bounds)
    near = None
    seen = np.full((q, n), -np.inf, np.float32)
    seen[:, start] = queries @ units[start]
    member = np.flatnonzero(own >= 0)
    seen[member, own[member]] = np.einsum("ij,ij->i", queries[member], units[own[member]])
    done = np.zeros((q, n), bool)
    active = np.arange(q)
    while len(active):
        here = seen[active]
        left = np.where(done[active], -np.inf, here)
        opened = left >= in_range
        least = np.partition(here, n - beam, axis=1)[:, n - beam] if n > beam else np.full(len(active), -np.inf)
        best = np.argpartition(-left, OPENED, axis=1)[:, :OPENED] if n > OPENED else np.tile(np.arange(n), (len(active), 1))
        value = np.take_along_axis(left, best, axis=1)
        row, k = np.nonzero((value > -np.inf) & (value >= least[:, None]))
        opened[row, best[row, k]] = True
        going = opened.any(axis=1)
        active, opened, here = active[going], opened[going], here[going]
        if not len(active):
            break
        done[active] |= opened
        row, at = np.nonzero(opened)
        if len(row) > 4 * OPENED * len(active):  # a large group in range
            if near is None:
                near = np.zeros((n, n), np.float32)
                near[np.repeat(np.arange(n), degree), flat] = 1
            new = opened.astype(np.float32) @ near > 0
        else:
            size = degree[at]
            ends = np.cumsum(size)
            place = np.repeat(bounds[at] - (ends - size), size) + np.arange(ends[-1])
            new = np.zeros(opened.shape, bool)
            new[np.repeat(row, size), flat[place]] = True
        new &= here == -np.inf
        row, at = np.nonzero(new)
        if 8 * len(row) < new.size:
            seen[active[row], at] = np.einsum("ij,ij->i", queries[active[row]], units[at])
        else:
            seen[active] = np.where(new, queries[active] @ units.T, here)
    return seen


def marked(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding as doubles, usable)."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    taken = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return taken.withColumn("usable", F.coalesce(F.col("label").isNotNull() & fine & some, F.lit(False)))


def centres(nodes: DataFrame, cosine: float) -> dict[tuple[str, int], np.ndarray]:
    """Cluster centres of the (label, length) classes that fill more than one shard.

    No centre is in range of another, so a group of near copies keeps one. The sample and the number of centres are bounded, whatever the input.
    """
    total = nodes.count()
    rate = min(1.0, SAMPLE / max(total, 1))
    picked = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < rate * 1_000_000).select("label", "dim", "embedding")
    shard = max(SHARD, total / MAX_CENTRES)
    out = {}
    for key, rows in picked.toPandas().groupby(["label", "dim"]):
        k = int(len(rows) / rate / shard)
        if k < 2:
            continue
        units = unit(np.stack(rows["embedding"]).astype(np.float64))
        random = np.random.default_rng(7)
        middle = units[random.choice(len(units), min(k, len(units)), replace=False)]
        for _ in range(8):
            nearest = (units @ middle.T).argmax(axis=1)
            sums = np.zeros_like(middle)
            np.add.at(sums, nearest, units)
            filled = np.abs(sums).sum(axis=1) > 0
            middle[filled] = unit(sums[filled])
        size = np.bincount((units @ middle.T).argmax(axis=1), minlength=len(middle))
        apart: list[int] = []
        for c in np.argsort(-size, kind="stable").tolist():
            if size[c] and (not apart or (middle[apart] @ middle[c]).max() < cosine):
                apart.append(c)
        out[(key[0], int(key[1]))] = middle[apart]
    return out


def near_centres(units: np.ndarray, middle: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, centre, rank): rank 0 the nearest centre, 1 the second, 2 others whose
    border with the nearest is within half the range angle.

    Of two vectors in range with unlike nearest centres one has the other's.
    """
    rows, found, ranks = [], [], []
    for at in range(0, len(units), 512):
        value = units[at : at + 512] @ middle.T
        all_ = np.arange(len(value))
        home = value.argmax(axis=1)
        best = np.take_along_axis(value, home[:, None], axis=1)
        between = np.sqrt(np.maximum(((middle * middle).sum(axis=1) + (middle[home] ** 2).sum(axis=1)[:, None]) - 2 * (middle[home] @ middle.T), 0))
        rank = np.where(best - value <= between * math.sqrt(max(1 - cosine, 0) / 2) + 1e-9, 2, 3)
        value[all_, home] = -np.inf
        rank[all_, value.argmax(axis=1)] = 1
        rank[all_, home] = 0
        row, centre = np.nonzero(rank < 3)
        rows.append(row + at)
        found.append(centre)
        ranks.append(rank[row, centre])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(ranks)


def sharded(nodes: DataFrame, middles: dict[tuple[str, int], np.ndarray], cosine: float) -> DataFrame:
    """(shard, home, others, member, v, embedding, copies): every vector in the shards of its near centres.

    ``home`` is the shard of its nearest centre, ``others`` are all its shards.
    A class without centres is one shard, numbered below zero by its hash.
    """
    first, at = {}, 0
    for key in sorted(middles):
        first[key], at = at, at + len(middles[key])
    names = ["shard", "home", "others", "member", "v", "embedding", "copies"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for key, rows in frame.groupby(["label", "dim"]):
                key = (key[0], int(key[1]))
                if key in middles and len(middles[key]) > 1:
                    row, near, rank = near_centres(unit(np.stack(rows["embedding"]).astype(np.float64)), middles[key], cosine)
                    near = first[key] + near
                else:
                    row, near, rank = np.arange(len(rows)), rows["lone"].to_numpy(), np.zeros(len(rows), np.int64)
                start = np.searchsorted(row, np.arange(len(rows) + 1))
                others = [near[a:b] for a, b in zip(start[:-1], start[1:])]
                made = rows[["v", "embedding", "copies"]].iloc[row].assign(
                    shard=near, home=near[rank == 0][row], others=[others[r] for r in row.tolist()], member=rank < 2
                )
                for at in range(0, len(made), 4096):
                    yield pa.RecordBatch.from_pandas(made[names].iloc[at : at + 4096], schema=schema, preserve_index=False)

    schema = pa.schema([("shard", pa.int64()), ("home", pa.int64()), ("others", pa.list_(pa.int64())), ("member", pa.bool_()),
                        ("v", pa.int64()), ("embedding", pa.list_(pa.float64())), ("copies", pa.int64())])
    lone = F.shiftrightunsigned(F.xxhash64("label", "dim"), 2).cast("bigint")
    return nodes.select("label", "dim", "v", "embedding", "copies", (-1 - lone).alias("lone")).mapInArrow(
        frugal(work),
        "shard bigint, home bigint, others array<bigint>, member boolean, v bigint, embedding array<double>, copies bigint",
    )


def cells(placed: DataFrame, work: Workspace) -> DataFrame:
    """Add ``cell``, a piece of members met by a piece of searchers, whether the
    row is a ``node`` and a ``query`` there, and its ``piece`` of members.

    A shard of ordinary size is one cell.
    """
    sizes = placed.groupBy("shard").agg(F.count_if("member").alias("members"), F.count("*").alias("rows"))

    def parts(size: str, most: int):
        return F.greatest(F.ceil(F.col(size) / F.lit(most)), F.lit(1)).cast("bigint")

    sizes = sizes.select("shard", parts("members", PIECE).alias("p"), parts("rows", SEARCHERS).alias("q"))
    cut = placed.join(sizes, "shard").withColumn("piece", F.pmod(F.xxhash64("v"), "p"))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("v", F.lit(1)), "q"))
    zero = F.lit(0).cast("bigint")
    searching = F.transform(F.sequence(zero, F.col("p") - 1), lambda j: j * F.col("q") + F.col("part"))
    holding = F.transform(F.sequence(zero, F.col("q") - 1), lambda k: F.col("piece") * F.col("q") + k)
    cut = cut.withColumn("cell", F.explode(F.when(F.col("member"), F.array_union(searching, holding)).otherwise(searching)))
    node = F.col("member") & (F.floor(F.col("cell") / F.col("q")) == F.col("piece"))
    query = F.col("cell") % F.col("q") == F.col("part")
    return work.write(cut.withColumn("node", node).withColumn("query", query).drop("p", "q", "part", "member"), "cells")


def adjacency(cut: DataFrame) -> DataFrame:
    """(v, near): the lists of all shards' graphs, united."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("v", ignore_index=True)
        units = unit(np.stack(rows["embedding"]))
        v = rows["v"].to_numpy()
        one, two = connected(units, pruned(units))
        order = np.argsort(one, kind="stable")
        return pd.DataFrame({"v": v, "near": np.split(v[two[order]], np.searchsorted(one[order], np.arange(1, len(v))))})

    # A member is a node in one cell with each piece of searchers; its first holds one row of each.
    members = cut.filter("node").select("shard", "piece", "v", "embedding").dropDuplicates(["shard", "piece", "v"])
    lists = members.groupBy("shard", "piece").applyInPandas(build, "v bigint, near array<bigint>")
    return lists.groupBy("v").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def merged(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Groups (each named by its smallest place) after joining those of the pairs a, b."""
    while True:
        one, two = group[a], group[b]
        apart = one != two
        if not apart.any():
            return group
        one, two = one[apart], two[apart]
        low = np.minimum(one, two)
        np.minimum.at(group, one, low)
        np.minimum.at(group, two, low)
        while True:
            shorter = group[group]
            if (shorter == group).all():
                break
            group = shorter


def links(cut: DataFrame, lists: DataFrame, cosine: float, exact: bool = False) -> DataFrame:
    """(v, n, root): by cell, how many vectors each one links with, and a spanning link."""

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("v", ignore_index=True)
        v, copies, home, shard = rows["v"].to_numpy(), rows["copies"].to_numpy(), rows["home"].to_numpy(), int(rows["shard"][0])
        node, query = np.flatnonzero(rows["node"]), np.flatnonzero(rows["query"])
        if not len(node) or not len(query):
            return pd.DataFrame({"v": [], "n": [], "root": []}).astype("int64")
        double = unit(np.stack(rows["embedding"]))
        single = double.astype(np.float32)
        nodes, searchers = single[node], single[query]
        # Neighbours in this cell, as places among the nodes.
        near = [np.asarray(x if x is not None else [], np.int64) for x in rows["near"].iloc[node]]
        source, names = np.repeat(np.arange(len(node)), [len(x) for x in near]), np.concatenate(near)
        place = np.minimum(np.searchsorted(v[node], names), len(node) - 1)
        known = v[node][place] == names
        source, place = source[known], place[known]
        graph = np.searchsorted(source, np.arange(len(node) + 1)), place
        own = np.full(len(rows), -1)
        own[node] = np.arange(len(node))
        own = own[query]
        medoid = medoid_of(double[node])
        found = np.zeros((len(query), len(node)), bool)
        for at in range(0, len(query), 256):
            part = slice(at, at + 256)
            found[part] = search(nodes, graph, medoid, searchers[part], own[part], cosine - SLACK) >= cosine - SLACK
            if exact:
                found[part] |= searchers[part] @ nodes.T >= cosine - SLACK
        # What one end found the other knows, where both search here.
        both = np.flatnonzero(own >= 0)
        square = found[np.ix_(both, own[both])]
        found[np.ix_(both, own[both])] = square | square.T
        found[both, own[both]] = False
        found[:, home[node] != shard] = False
        # Pairs that the other end's nearest shard counts, as its number is smaller.
        visiting = home[query] != shard
        elsewhere, column = np.unique(home[query], return_inverse=True)
        lengths = rows["others"].iloc[node].map(len).to_numpy()
        theirs = np.concatenate(rows["others"].iloc[node].tolist())
        at = np.minimum(np.searchsorted(elsewhere, theirs), len(elsewhere) - 1)
        met = (elsewhere[at] == theirs) & (theirs < shard)
        counted = np.zeros((len(elsewhere), len(node)), bool)
        counted[at[met], np.repeat(np.arange(len(node)), lengths)[met]] = True
        counts, touched, group = np.zeros(len(v), np.int64), np.zeros(len(v), bool), np.arange(len(v))
        for at in range(0, len(query), 256):
            part = found[at : at + 256] & ~(counted[column[at : at + 256]] & visiting[at : at + 256, None])
            q, k = np.nonzero(part)
            for begin in range(0, len(q), 1 << 15):
                a, b = query[at + q[begin : begin + (1 << 15)]], node[k[begin : begin + (1 << 15)]]
                sure = np.einsum("ij,ij->i", double[a], double[b]) >= cosine
                a, b = a[sure], b[sure]
                np.add.at(counts, a, copies[b])
                guest = home[a] != shard  # the other end does not search for this one
                np.add.at(counts, b[guest], copies[a[guest]])
                touched[a] = touched[b] = True
                group = merged(group, a, b)
        return pd.DataFrame({"v": v[touched], "n": counts[touched], "root": v[group[touched]]})

    joined = cut.join(lists, "v", "left")
    return joined.groupBy("shard", "cell").applyInPandas(find, "v bigint, n bigint, root bigint")


def groups(rows: DataFrame, work: Workspace, cosine: float = COSINE, exact: bool = False) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): n_links, component_id, kept.

    With ``exact`` no pair that a search missed is lost, at the cost of all
    products within a shard.
    """
    rows = work.write(marked(rows), "rows")
    key = digest(F.col("label"), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ","))
    good = rows.filter("usable").withColumn("node", key)
    nodes = good.groupBy("node").agg(
        F.first("embedding").alias("embedding"), F.first("label").alias("label"), F.count("*").alias("copies"),
        F.min("vec_id").alias("vec_id"),
    )
    nodes = work.write(nodes.withColumn("dim", F.size("embedding")).withColumn("v", F.monotonically_increasing_id()), "nodes")
    cut = cells(sharded(nodes, centres(nodes, cosine), cosine), work)
    lists = work.write(adjacency(cut), "lists")
    found = work.write(links(cut, lists, cosine, exact), "links")
    roots = components(found.select(F.col("v").alias("a"), F.col("root").alias("b")), work, "roots")
    sums = found.groupBy("v").agg(F.sum("n").alias("n"))
    known = nodes.select("v", "node", "vec_id", "copies").join(sums, "v", "left").join(roots.withColumnRenamed("node", "v"), "v", "left")
    known = known.withColumn("root", F.coalesce("root", "v"))
    names = known.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    known = known.join(names, "root").select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = good.select("vec_id", "node").join(known, "node").select("vec_id", "n_links", "component_id")
    rest = rows.filter("not usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit_recall(rows: DataFrame, found: DataFrame, work: Workspace, cosine: float = COSINE, every: int = 20) -> float:
    """Share of the true links of the rows whose id ``every`` divides that ``found`` holds.

    Brute force over all rows, block by block: the queries of a block meet
    every row of their label once.
    """
    kept = marked(rows).filter("usable")
    block = F.floor(F.col("vec_id") / (every * 256)).alias("block")
    queries = work.write(kept.filter(F.col("vec_id") % every == 0).select("vec_id", "label", "embedding", block), "queries")
    places = queries.select("label", "block").distinct()
    meet = kept.select("vec_id", "label", "embedding").join(F.broadcast(places), "label").join(
        queries.select(F.col("vec_id").alias("q"), F.col("embedding").alias("e"), "label", "block"), ["label", "block"]
    )
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    value = dot("e", "embedding") / F.sqrt(dot("e", "e") * dot("embedding", "embedding"))
    true = meet.filter((F.col("q") != F.col("vec_id")) & (value >= cosine)).groupBy("q").agg(F.count("*").alias("n"))
    both = true.join(found.select(F.col("vec_id").alias("q"), "n_links"), "q", "left")
    sums = both.agg(F.sum(F.least("n", F.coalesce("n_links", F.lit(0)))).alias("found"), F.sum("n").alias("n")).first()
    return sums["found"] / sums["n"] if sums["n"] else 1.0
