"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A text's set of word shingles gets ``SYMBOLS`` min-hashes of 16 bits each. Two
sets of similarity 0.8 differ in 6.4 of 32 symbols on average, and in more than
``DISTANCE`` about once in ten thousand pairs. The signature is cut into
``CHUNKS`` chunks: of two signatures at most DISTANCE apart, some chunk has at
most DISTANCE // CHUNKS = 1 differing symbol (pigeonhole). So every chunk is
filed under all its versions with one symbol left out, and each pair within the
distance meets under some key.

Under a key only a shortest spanning forest of the members within the distance
is proposed, not all pairs, and each proposal is confirmed on the full shingle
sets. Proposals join the nodes into families; every pair within the distance
lies in one. In a family whose confirmed links leave several components, pairs
across components are compared on full sets inside the tasks, in pieces of
bounded size that meet pairwise, and only spanning links leave a task. So no
link inside a family is missed, and no group's pairs are written out. A pair
beyond DISTANCE that no other near copy brings into one family stays unlinked:
at similarity 0.8 about 1.4 in ten thousand pairs, fewer above.
Equal sets are one node from the start. A key with very many members is split
into blocks that meet pairwise.

Defined results: a text without words, or null, has no set and is alone; fewer
words than a shingle count as one shingle; repeated rows are copies; null ids
count only if a group has no other; the smallest doc_id names a component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import components, free_name, frugal, give_back, numbered, small_batches, without_few, word_codes
from starloom.sources.workspace import Workspace

WIDTH = 5
PERCENT = 80
SYMBOLS, CHUNKS = 32, 8
PER_CHUNK = SYMBOLS // CHUNKS
DISTANCE = 2 * CHUNKS - 1
HOT = 8192
FILTER_BITS = 23

# A family's pieces: few nodes while that makes few pieces, then more up to a bound.
PIECE, MANY_PIECES, LARGE_PIECE, PIECE_VALUES = 128, 32, 1024, 1_000_000

_RANDOM = np.random.default_rng(20240229)
FACTORS = _RANDOM.integers(1 << 62, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles, A-Z in lower case."""
    bounds, codes, distinct = word_codes(pc.ascii_lower(pc.fill_null(texts, "")))
    if distinct:
        hashes = pd.util.hash_array(np.array(distinct, object), categorize=False)[codes]
    else:
        hashes = np.zeros(0, np.uint64)
    whole = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for k in range(width):
        whole = _mixed(whole + hashes[k : k + len(whole)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            yield np.unique(whole[a : b - width + 1])
        elif b > a:
            one = np.full(1, b - a, np.uint64)  # the number of words keeps it apart from full shingles
            for k in range(a, b):
                one = _mixed(one + hashes[k : k + 1])
            yield one
        else:
            yield np.zeros(0, np.uint64)


def signature(values: np.ndarray) -> bytes:
    """The 16-bit min-hashes of a set."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 4096):
        np.minimum(low, (values[at : at + 4096, None] * FACTORS + SHIFTS).min(axis=0), out=low)
    return (_mixed(low) >> np.uint64(48)).astype("<u2").tobytes()


def node_of(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.astype("<u8").tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` without its text, with n_shingles, node (the set's digest) and sig."""
    others = [c for c in docs.columns if c != "text"]
    schema = docs.select(*others).schema.add("n_shingles", "long").add("node", "binary").add("sig", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sizes, nodes, sigs = [], [], []
            for values in shingle_sets(batch.column("text"), width):
                sizes.append(len(values))
                nodes.append(node_of(values) if len(values) else None)
                sigs.append(signature(values) if len(values) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())]
            yield pa.record_batch([*(batch.column(c) for c in others), *made], names=[*others, "n_shingles", "node", "sig"])

    return docs.select(*others, "text").mapInArrow(frugal(work), schema)


def filed(nodes: DataFrame) -> DataFrame:
    """(key, v, sig): every node under all versions of its chunks with one symbol left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(n, CHUNKS, PER_CHUNK)
            keys = []
            for left_out in range(PER_CHUNK):
                key = np.zeros((n, CHUNKS), np.uint64) + np.arange(CHUNKS, dtype=np.uint64) + np.uint64(left_out * CHUNKS)
                for p in range(PER_CHUNK):
                    if p != left_out:
                        key = _mixed(key * np.uint64(65537) + sig[:, :, p])
                keys.append(key)
            keys = np.concatenate(keys, axis=1).reshape(-1)
            # One byte per symbol tells distances apart; equal 16 bits give equal bytes.
            short = (sig.reshape(n, SYMBOLS) & 0xFF).astype(np.uint8)
            each = np.repeat(np.arange(n), CHUNKS * PER_CHUNK)
            raw = short.tobytes()
            sigs = pa.array([raw[i : i + SYMBOLS] for i in range(0, len(raw), SYMBOLS)], pa.binary())
            yield pa.record_batch(
                [pa.array(keys.view(np.int64)), batch.column("v").take(pa.array(each)), sigs.take(pa.array(each))],
                names=["key", "v", "sig"],
            )

    return nodes.select("v", "sig").mapInArrow(frugal(work), "key bigint, v bigint, sig binary")


def forest(v: np.ndarray, sig: np.ndarray) -> tuple[list[int], list[int]]:
    """Pairs of a shortest spanning forest of the members at most DISTANCE apart (Prim's steps)."""
    n = len(v)
    best, parent = np.full(n, SYMBOLS + 1, np.int64), np.zeros(n, np.int64)
    out = np.zeros(n, bool)
    at, a, b = 0, [], []
    for _ in range(n - 1):
        out[at] = True
        apart = (sig != sig[at]).sum(axis=1)
        nearer = (apart < best) & ~out
        best[nearer], parent[nearer] = apart[nearer], at
        at = int(np.where(out, SYMBOLS + 2, best).argmin())
        if best[at] <= DISTANCE:
            a.append(int(v[parent[at]]))
            b.append(int(v[at]))
    return a, b


def proposals(nodes: DataFrame, work: Workspace) -> DataFrame:
    """(a, b) with a < b, stored: pairs to confirm."""
    keyed = filed(nodes)
    hot = work.write(filed(nodes).groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT), "hot")
    if hot.isEmpty():
        keyed = keyed.withColumn("pair", F.lit(0).cast("bigint"))
    else:
        # Blocks i and j of a hot key meet in cell (i, j); rows of other keys stay alone.
        blocks = F.coalesce(F.ceil(2 * F.col("n") / HOT), F.lit(1)).cast("bigint")
        mine = F.pmod(F.xxhash64("v"), F.col("blocks"))
        cells = F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
            lambda other: F.least(other, F.col("mine")) * F.col("blocks") + F.greatest(other, F.col("mine")),
        )
        keyed = keyed.join(hot, "key", "left").withColumn("blocks", blocks).withColumn("mine", mine)
        keyed = keyed.select("key", F.explode(cells).alias("pair"), "v", "sig")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(a: list, b: list) -> pa.RecordBatch:
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        def buckets(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            n = rows.num_rows
            key, pair, v = (rows.column(c).to_numpy() for c in ("key", "pair", "v"))
            starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (pair[1:] != pair[:-1]))))
            sizes = np.diff(np.concatenate((starts, [n])))
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(n, SYMBOLS)
            twos = starts[sizes == 2]
            close = (sig[twos] != sig[twos + 1]).sum(axis=1) <= DISTANCE
            yield found(v[twos[close]], v[twos[close] + 1])
            for s, k in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                yield found(*forest(v[s : s + k], sig[s : s + k]))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last key of a batch may go on in the next one.
            key, pair = batch.column("key").to_numpy(), batch.column("pair").to_numpy()
            ends = np.flatnonzero((key != key[-1]) | (pair != pair[-1]))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut or (held and (held[-1].column("key")[-1].as_py(), held[-1].column("pair")[-1].as_py()) != (key[-1], pair[-1])):
                yield from buckets(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from buckets(pa.Table.from_batches(held))

    dealt = keyed.repartition("key", "pair").sortWithinPartitions("key", "pair", "v")
    return work.write(dealt.mapInArrow(frugal(meet), "a bigint, b bigint").distinct(), "pairs")


def sets_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, work: Workspace) -> DataFrame:
    """(v, n, values), stored: the full shingle sets of the nodes in ``pairs``.

    The texts are read again, past a bit map of fixed size over the doc_ids
    wanted, so that sets are made and kept for these documents only.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    wanted = work.write(nodes.join(ends, "v").select("v", "node", "doc_id"), "wanted")
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))
    spots = wanted.select(place(F.col("doc_id")).alias("p")).groupBy(F.shiftright("p", 5).alias("word"))
    bits = spots.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("p") % 32).cast("int"))).alias("bits")).collect()
    table = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for r in bits:
        table[r["word"]] = r["bits"]
    flags = np.unpackbits(table.view(np.uint8), bitorder="little")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = batch.filter(pa.array(flags[batch.column("place").to_numpy()] == 1))
            for some in small_batches([picked], "text"):
                made = [x for x in shingle_sets(some.column("text"), width) if len(x)]
                yield pa.record_batch(
                    [
                        pa.array([node_of(x) for x in made], pa.binary()),
                        pa.array([len(x) for x in made], pa.int64()),
                        pa.array([x.view(np.int64) for x in made], pa.list_(pa.int64())),
                    ],
                    names=["node", "n", "values"],
                )

    read = docs.select("text", place(F.col("doc_id").cast("bigint")).alias("place"))
    made = read.mapInArrow(frugal(make), "node binary, n bigint, values array<bigint>")
    kept = made.join(wanted.select("v", "node"), "node").groupBy("v").agg(F.first("n").alias("n"), F.first("values").alias("values"))
    return work.write(kept, "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of similarity ``percent`` or more, on full sets."""
    sizes = sets.select("v", "n")
    left, right = (sizes.select(F.col("v").alias(c), F.col("n").alias(f"n{c}")) for c in ("a", "b"))
    possible = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    pairs = pairs.select("a", "b").join(left, "a").join(right, "b").filter(possible)
    both = pairs.join(sets.select(F.col("v").alias("a"), F.col("values").alias("x")), "a")
    both = both.join(sets.select(F.col("v").alias("b"), F.col("values").alias("y")), "b")
    both = both.select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).alias("common"))
    return both.filter(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent).select("a", "b")


def between_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): the roots of the ends of ``pairs`` where they differ; a node without a root is its own."""
    for end in ("a", "b"):
        named = roots.select(F.col("node").alias(end), "root")
        pairs = pairs.join(named, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    return pairs.select("a", "b").filter("a <> b")


def across(pairs: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """(a, b), stored: spanning links between the components of each family.

    ``pairs`` joined into components are the families. Only those whose members
    have several roots are looked at: pairs that part roots are joined, root by root.
    """
    families = components(between_roots(pairs, roots), work, "families").withColumnRenamed("root", "family")
    linked = roots.join(families.withColumnRenamed("node", "root"), "root").select("family", F.col("node").alias("v"), F.col("root").alias("label"))
    alone = families.join(roots, "node", "left_anti").select("family", F.col("node").alias("v"), F.col("node").alias("label"))
    members = linked.unionByName(alone)
    sizes = members.join(sets.select("v", "n"), "v").groupBy("family").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    few = F.least(F.ceil(F.col("size") / PIECE), F.lit(MANY_PIECES))
    pieces = F.greatest(few, F.ceil(F.col("size") / LARGE_PIECE), F.ceil(F.col("total") / PIECE_VALUES)).cast("bigint")
    undecided = work.write(sizes.select("family", pieces.alias("pieces")), "undecided")
    piece = F.pmod(F.xxhash64("v"), F.col("pieces"))
    cells = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1),
        lambda other: F.least(other, piece) * F.col("pieces") + F.greatest(other, piece),
    )
    placed = members.join(undecided, "family").select("family", "v", "label", F.explode(cells).alias("cell"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between different labels, shingle by shingle through the list of its holders."""
        values = rows["values"].tolist()
        v, label, n = rows["v"].to_numpy(), rows["label"].to_numpy(), np.array([len(x) for x in values])
        flat = np.concatenate(values)
        holder = np.repeat(np.arange(len(v)), n)
        order = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[order], flat, "right")
        starts = np.searchsorted(flat[order], flat, "left")
        holders, first = holder[order], np.cumsum(n) - n
        group, a, b = np.unique(label, return_inverse=True)[1], [], []
        for i in range(len(v)):
            if (group == group[i]).all():
                break
            own = slice(first[i], first[i] + n[i])
            size = ends[own] - starts[own]
            at = np.repeat(starts[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            common = np.bincount(holders[at], minlength=len(v))
            linked = np.flatnonzero((common * 100 >= (n + n[i] - common) * percent) & (group != group[i]))
            for j in linked.tolist():
                if group[j] != group[i]:
                    a.append(v[i])
                    b.append(v[j])
                    group[group == group[j]] = group[i]
        if len(flat) > 1 << 20:
            del values, flat, holder, order, ends, starts, holders
            give_back()
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    full = placed.join(sets.select("v", "values"), "v")
    return work.write(full.groupBy("family", "cell").applyInPandas(compare, "a bigint, b bigint"), "across")


def groups(docs: DataFrame, work: Workspace, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` without text, with n_shingles and component_id.

    ``docs`` needs doc_id and text; other columns are carried along.
    """
    return rooted(docs, work, width, percent).drop("root")


def rooted(docs: DataFrame, work: Workspace, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """As ``groups``, with ``root``: one number per component, null without words.

    Null and shared doc_ids make component_id ambiguous; root is not.
    """
    sketched = work.write(sketches(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), width), "sketches")
    nodes = sketched.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    nodes = work.write(nodes.withColumn("v", F.monotonically_increasing_id()), "nodes")
    pairs = proposals(nodes, work)
    sets = sets_of(docs, nodes, pairs, width, work)
    links = work.write(confirmed(pairs, sets, percent), "links")
    roots = components(links, work, "roots")
    more = across(pairs, roots, sets, percent, work)
    if not more.isEmpty():
        tops = components(between_roots(more, roots), work, "all-roots")
        moved = roots.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
        alone = tops.join(roots, "node", "left_anti").select("node", "root")
        roots = moved.select("node", F.coalesce("top", "root").alias("root")).unionByName(alone)
    tree = nodes.select("v", "node", "doc_id").join(roots.withColumnRenamed("node", "v"), "v", "left")
    tree = tree.withColumn("root", F.coalesce("root", "v"))
    names = tree.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = tree.join(names, "root").select("node", "component_id", "root")
    joined = sketched.drop("sig").join(named, "node", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return joined.drop("node")


def keep_one(docs: DataFrame, work: Workspace, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every group of near copies: the smallest doc_id, one of equal rows.

    Groups are told by their links, never by doc_id: unlike texts with a null or
    shared doc_id all stay. Rows without words all stay.
    """
    stored, row = numbered(docs, work, "rows")
    inner = Workspace(work.spark, "near-copies")
    found = rooted(stored.select("doc_id", "text", row), inner, width, percent)
    lone = F.col("n_shingles") == 0
    group = F.when(lone, F.col(row)).otherwise(F.col("root"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first")
    winners = found.groupBy(lone.alias("lone"), group.alias("group")).agg(first).select(F.col(f"first.{row}").alias(row))
    # Fewer rows leave than stay.
    losers = work.write(found.select(row).join(work.write(winners, "winners"), row, "left_anti"), "losers")
    inner.remove()
    work.discard("winners")
    return without_few(stored, losers, row).drop(row).select(*docs.columns)
