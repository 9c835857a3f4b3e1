"""Best-fit packing of documents into token sequences by large-item matching.

Pieces over one third of the capacity share a sequence at most in pairs, so
they are matched greedily, longest first, each with the longest partner that
still fits. The smaller pieces then go, longest first, into the smallest gap
that holds them, and open new sequences when none does.

Lengths are whole numbers up to the capacity. All pieces of one length are
alike to the packing, so it runs on the count of pieces per length and yields
runs: "pieces r to r+n of length L lie at offset o of the sequences s to s+n".
The counts are a table of at most ``capacity`` rows whatever the input; the
pieces themselves find their run by their rank within their length.

Defined results: a null text is an empty one (its tokens are the end id only);
repeated rows and null ids are packed like any others, each row by itself; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WordEncoder, frugal, numbered, small_batches  # noqa: F401
from starloom.operators.index import with_index
from starloom.sources.workspace import Workspace

# Bytes of text encoded at once.
BATCH_BYTES = 1 << 23
CAPACITY = 2048
END_ID = 0

Run = tuple[int, int, int, int, int]  # length, first rank, pieces, first sequence, offset


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place ``counts[length]`` pieces of every length."""
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: [(first sequence, how many)]
    sequences = 0

    def place(length: int, many: int, first: int, offset: int) -> None:
        runs.append((length, used[length], many, first, offset))
        used[length] += many
        left[length] -= many

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            partner = next((p for p in reversed(large[: bisect.bisect_right(large, capacity - length)]) if left[p]), None)
            if partner is None:
                many = left[length]
            elif partner == length:
                many = left[length] // 2
                partner = partner if many else None
                many = many or 1
            else:
                many = min(left[length], left[partner])
            place(length, many, sequences, 0)
            if partner is not None:
                place(partner, many, sequences, length)
            gaps[capacity - length - (partner or 0)].append((sequences, many))
            sequences += many
    sizes = sorted(g for g in gaps if g)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):  # no gap holds it: open as many sequences as these pieces fill
                each = capacity // length
                many = -(-left[length] // each)
                gaps[capacity].append((sequences, many))
                bisect.insort(sizes, capacity)
                sequences += many
                continue
            gap = sizes[at]
            first, there = gaps[gap].pop()
            many = min(there, left[length])
            if there > many:
                gaps[gap].append((first + many, there - many))
            elif not gaps[gap]:
                sizes.pop(at)
            place(length, many, first, capacity - gap)
            if gap > length:
                if not gaps[gap - length]:
                    bisect.insort(sizes, gap - length)
                gaps[gap - length].append((first, many))
    return runs


def pieces(
    docs: DataFrame,
    vocabulary: str,
    work: Workspace,
    name: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = True,
    batch_bytes: int = BATCH_BYTES,
    remember: int | None = None,
) -> DataFrame:
    """Every document's ids in pieces of at most ``capacity``, stored.

    (doc_row, doc_id, piece, start, length, ids_crc32, ids); ``ids`` holds
    little-endian unsigned 32-bit numbers and is there with ``keep_ids`` only.
    """
    names = ["doc_row", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids binary" if keep_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.at(vocabulary, remember)
        end = np.array([end_id], "<u4").tobytes()
        for batch in small_batches(batches, "text", batch_bytes):
            flat, bounds = encoder.encode(batch.column("text"))
            raw, bounds = flat.tobytes(), bounds.tolist()
            doc, number, start, ids = [], [], [], []
            for i in range(batch.num_rows):
                whole = raw[4 * bounds[i] : 4 * bounds[i + 1]] + end
                for k in range(0, len(whole) // 4, capacity):
                    doc.append(i)
                    number.append(k // capacity)
                    start.append(k)
                    ids.append(whole[4 * k : 4 * (k + capacity)])
            doc = pa.array(doc, pa.int64())
            columns = [
                batch.column("doc_row").take(doc),
                batch.column("doc_id").take(doc),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            ]
            yield pa.record_batch(columns + [pa.array(ids, pa.binary())] * keep_ids, names=names)

    source = docs.select(F.monotonically_increasing_id().alias("doc_row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return work.write(source.mapInArrow(frugal(cut), schema), name)


def pack(
    docs: DataFrame,
    vocabulary: str,
    work: Workspace,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = True,
    batch_bytes: int = BATCH_BYTES,
    remember: int | None = None,
) -> DataFrame:
    """Place every piece: the columns of ``pieces`` with sequence_id and offset.

    Selecting only narrow columns leaves the ids in storage; without
    ``keep_ids`` only their crc32 is stored. Smaller batches of text, and fewer
    words to ``remember`` between them, take less memory and more time.
    """
    stored = pieces(docs, vocabulary, work, "pieces", capacity, end_id, keep_ids, batch_bytes, remember)
    keys = stored.select("length", "doc_row", "piece")
    ranked, _ = with_index(keys, ["length", "doc_row", "piece"], work, "ranked")
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for length in sorted(counts):
        before[length], total = total, total + counts[length]
    # Runs in the order of the ranked pieces: each starts at a number of its own.
    runs = sorted((before[n] + rank, many, first, offset) for n, rank, many, first, offset in plan(counts, capacity))
    starts = np.array([r[0] for r in runs], np.int64)
    firsts = np.array([r[2] for r in runs], np.int64)
    offsets = np.array([r[3] for r in runs], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx = batch.column("idx").to_numpy()
            at = np.searchsorted(starts, idx, "right") - 1
            yield pa.record_batch(
                [batch.column("doc_row"), batch.column("piece"), pa.array(firsts[at] + idx - starts[at]), pa.array(offsets[at])],
                names=["doc_row", "piece", "sequence_id", "offset"],
            )

    schema = "doc_row bigint, piece int, sequence_id bigint, offset bigint"
    placed = ranked.select("doc_row", "piece", "idx").mapInArrow(frugal(place), schema)
    return stored.join(placed, ["doc_row", "piece"])


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences, pieces joined by offset.

    A group holds one sequence, never more than the capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
