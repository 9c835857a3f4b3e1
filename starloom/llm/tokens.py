"""Token files: frequency-ranked ids in byte-aligned codes with separate control bytes.

Ids are ranked by how often the whole corpus uses them, so the common ones get
the short codes. A rank takes one to four bytes; two bits per rank say how
many, four ranks to a control byte. Control bytes and data bytes are separate
streams, so a block is decoded by table look-ups on whole arrays.

A file is a Parquet file of blocks in ascending document order: part and block
number the file and the block in it, base counts the ids of the file before the
block, doc_ids and doc_counts list its documents, control and data are the two
streams. Every document starts a control byte of its own. A block holds whole
documents, and is closed when it has ``BLOCK_IDS`` ids. The ranks are a table
beside the files.

Defined results: a null text is an empty one (only the end id); repeated rows
are stored each by itself; null doc_ids come first; documents that share a
doc_id are ordered by their text's digest, equal ones are interchangeable; an
empty table gives files without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import WordEncoder, digest, frugal, pieces, small_batches
from starloom.sources.workspace import Workspace

END_ID = 2
BLOCK_IDS = 1 << 18
# Bytes of text whose words are looked up together.
LOOK_UP_BYTES = 1 << 26
# Ids packed at once.
PACKED_IDS = 1 << 20

# Byte counts (1 to 4) of the four ranks behind each control byte, and their sum.
SIZES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
BLOCK_SCHEMA = (
    "part int, block int, base bigint, doc_ids array<bigint>, doc_counts array<bigint>, control binary, data binary"
)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8)
    if len(ranks) and int(ranks.max()) > 0xFFFF:
        extra += (ranks > 0xFFFF).astype(np.uint8) + (ranks > 0xFFFFFF).astype(np.uint8)
    quads = np.zeros((len(ranks) + 3) // 4 * 4, np.uint8)
    quads[: len(ranks)] = extra
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def pack_documents(ranks: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, np.ndarray, np.ndarray]:
    """As ``pack_ranks`` for many documents with ``counts`` ranks each, end to end:
    control bytes, data bytes, and the bounds of each document in both."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8)
    if len(ranks) and int(ranks.max()) > 0xFFFF:
        extra += (ranks > 0xFFFF).astype(np.uint8) + (ranks > 0xFFFFFF).astype(np.uint8)
    starts = np.concatenate(([0], np.cumsum(counts)))
    quad = np.concatenate(([0], np.cumsum((counts + 3) // 4)))
    quads = np.zeros(4 * int(quad[-1]), np.uint8)
    quads[np.arange(len(ranks)) + np.repeat(4 * quad[:-1] - starts[:-1], counts)] = extra
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    ends = np.concatenate(([0], np.cumsum(extra, dtype=np.int64)))[starts] + starts
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes(), quad, ends


def unpack_ranks(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of a block of documents with ``counts`` ranks each, by table look-up."""
    sizes = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)
    ends = np.cumsum((counts + 3) // 4 * 4)
    real = np.ones(len(sizes), bool)
    for pad in range(1, 4):  # a document's last control byte may stand for fewer than four
        real[ends[-counts % 4 >= pad] - pad] = False
    sizes = sizes[real]
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype("<u4")
    for byte in range(1, int(sizes.max()) if len(sizes) else 0):
        more = np.flatnonzero(sizes > byte)
        out[more] |= raw[starts[more] + byte].astype("<u4") << np.uint32(8 * byte)
    return out


def encode(docs: DataFrame, vocabulary: str, work: Workspace, end_id: int = END_ID) -> DataFrame:
    """(doc_id, tie, n_tokens, ids), stored: every document's ids, two or four bytes each."""
    schema = "doc_id bigint, tie binary, n_tokens bigint, ids binary"

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.at(vocabulary)
        # Two bytes an id where the vocabulary allows it.
        kind = "<u2" if max(len(encoder.ends) - 1, end_id) < 1 << 16 else "<u4"
        end = np.array([end_id], kind).tobytes()
        # Many texts at once have few distinct words: each is looked up once for all of them.
        for batch in small_batches(batches, "text", LOOK_UP_BYTES):
            doc, tie = batch.column("doc_id"), batch.column("tie")
            for a, b, flat, bounds in encoder.encode_pieces(batch.column("text"), kind):
                raw, width = flat.tobytes(), flat.itemsize
                cuts = (bounds * width).tolist()
                yield pa.record_batch(
                    [
                        doc.slice(a, b - a),
                        tie.slice(a, b - a),
                        pa.array(np.diff(bounds) + 1),
                        pa.array([raw[i:j] + end for i, j in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names=["doc_id", "tie", "n_tokens", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("tie"), "text")
    stored = rows.mapInArrow(frugal(ids), schema)
    stored.write.mode("overwrite").option("compression", "zstd").parquet(work.path("ids"))
    return work.read(stored, "ids")


def frequency_ranks(encoded: DataFrame, work: Workspace) -> DataFrame:
    """(id, n, rank): ids by falling count over the whole corpus, ties to the smaller id.

    Tasks send one count per id they use; the result has at most as many rows
    as the vocabulary.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(_all_numbers(batch.column("ids"), batch.column("n_tokens")))
            if len(found) > len(total):
                found[: len(total)] += total
                total = found
            else:
                total[: len(found)] += found
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["id", "n"])

    counts = encoded.select("ids", "n_tokens").mapInArrow(frugal(count), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    found = work.write(counts, "counts")
    ordered = [r["id"] for r in found.orderBy(F.desc("n"), "id").select("id").collect()]
    spark = encoded.sparkSession
    ranks = spark.createDataFrame([(i, k) for k, i in enumerate(ordered)], "id bigint, rank bigint")
    return work.write(found.join(F.broadcast(ranks), "id"), "ranks")


def _numbers(raw: pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw.size == 2 * n else "<u4")


def _all_numbers(ids: pa.BinaryArray, counts: pa.Array) -> np.ndarray:
    """The ids of all rows, which lie end to end in the column; all have one width."""
    if not len(ids):
        return np.zeros(0, "<u2")
    kind = "<i8" if pa.types.is_large_binary(ids.type) else "<i4"
    bounds = np.frombuffer(ids.buffers()[1], kind)[ids.offset : ids.offset + len(ids) + 1]
    raw = ids.buffers()[2].slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
    return _numbers(raw, int(np.sum(counts.to_numpy())))


def write_files(docs: DataFrame, vocabulary: str, work: Workspace, name: str = "files", end_id: int = END_ID) -> tuple[str, str]:
    """Encode ``docs`` into files below ``work``; the paths of the files and of the ranks."""
    encoded = encode(docs, vocabulary, work, end_id)
    ranks = frequency_ranks(encoded, work)
    pairs = ranks.select("id", "rank").collect()  # one row per id of the vocabulary
    table = np.zeros(max((r["id"] for r in pairs), default=0) + 1, "<u4")
    for r in pairs:
        table[r["id"]] = r["rank"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = base = size = 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            docs, counts, control, data = zip(*held)
            doc, n = chain.from_iterable(docs), chain.from_iterable(counts)
            return pa.record_batch(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([base], pa.int64()),
                    pa.array([list(doc)], pa.list_(pa.int64())),
                    pa.array([list(n)], pa.list_(pa.int64())),
                    pa.array([b"".join(control)], pa.binary()),
                    pa.array([b"".join(data)], pa.binary()),
                ],
                names=["part", "block", "base", "doc_ids", "doc_counts", "control", "data"],
            )

        for batch in batches:
            part = batch.column("part")[0].as_py()
            for first, last in pieces(batch.column("n_tokens").to_numpy(), PACKED_IDS):
                rows = batch.slice(first, last - first)
                docs, sizes = rows.column("doc_id").to_pylist(), rows.column("n_tokens").to_pylist()
                ranked = table[_all_numbers(rows.column("ids"), rows.column("n_tokens"))]
                control, data, quad, ends = pack_documents(ranked, rows.column("n_tokens").to_numpy())
                a = 0
                for b, n in enumerate(sizes, 1):
                    size += n
                    if size >= BLOCK_IDS or b == len(sizes):
                        held.append((docs[a:b], sizes[a:b], control[quad[a] : quad[b]], data[ends[a] : ends[b]]))
                        a = b
                    if size >= BLOCK_IDS:
                        yield block()
                        number, base, size, held = number + 1, base + size, 0, []
        if held:
            yield block()

    # Boundaries are sampled from the stored keys; ids are packed behind the shuffle, once.
    # The place among the stored rows parts many equal ones.
    order = ["doc_id", "tie", "place"]
    ordered = encoded.withColumn("place", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("doc_id", "n_tokens", "ids", F.spark_partition_id().alias("part"))
    ordered.mapInArrow(frugal(blocks), BLOCK_SCHEMA).write.mode("overwrite").option("compression", "zstd").parquet(work.path(name))
    work.discard("ids")
    return work.path(name), work.path("ranks")


def read_files(spark: SparkSession, files: str, ranks: str) -> DataFrame:
    """Decode the files: (doc_id, start, n_tokens, ids), ids as little-endian unsigned 32-bit numbers."""
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(files)
    pairs = spark.read.parquet(ranks).select("rank", "id").collect()  # one row per id of the vocabulary
    table = np.zeros(max((r["rank"] for r in pairs), default=0) + 1, "<u4")
    for r in pairs:
        table[r["rank"]] = r["id"]
    # One number per file goes to the driver.
    size = F.aggregate("doc_counts", F.lit(0).cast("bigint"), lambda total, n: total + n)
    sums = sorted((r["part"], r["n"]) for r in stored.groupBy("part").agg(F.sum(size).alias("n")).collect())
    before = list(zip((p for p, _ in sums), accumulate((n for _, n in sums), initial=0)))
    offsets = spark.createDataFrame(before, "part int, before bigint")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                base, docs, counts, control, data = (batch.column(c)[r].as_py() for c in columns)
                counts = np.array(counts, np.int64)
                raw = table[unpack_ranks(control, data, counts)].tobytes()
                ends = np.cumsum(counts)
                cuts = [0, *(ends * 4).tolist()]
                yield pa.record_batch(
                    [
                        pa.array(docs, pa.int64()),
                        pa.array(base + ends - counts),
                        pa.array(counts),
                        pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    columns = ["base", "doc_ids", "doc_counts", "control", "data"]
    placed = stored.join(F.broadcast(offsets), "part").withColumn("base", F.col("base") + F.col("before"))
    return placed.select(*columns).mapInArrow(frugal(decode), "doc_id bigint, start bigint, n_tokens bigint, ids binary")
