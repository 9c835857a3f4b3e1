"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.sources.workspace import Workspace

# One word: anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != F.lit(""))


def crc32_text(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def digest(*parts: Column) -> Column:
    """A 128-bit key of the given values: wide enough for any number of rows."""
    return F.unhex(F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts])))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, work: Workspace, name: str) -> tuple[DataFrame, str]:
    """``df`` stored with a unique number per row, and that column's name.

    The number stands for one stored row: repeated rows and null ids stay
    apart, and a lost executor reads the same numbers again.
    """
    row = free_name(df, "row_number_")
    return work.write(df.withColumn(row, F.monotonically_increasing_id()), name), row


# What a task holds of a table that goes to all of them.
FEW_BYTES = 64 << 20


def with_few(rows: DataFrame, few: DataFrame, row: str, size: Column) -> DataFrame:
    """``rows`` left-joined with a stored table of some of them, one line each, by ``row``.

    ``size`` bounds a line's bytes. A table within FEW_BYTES goes to all tasks.
    Of a larger one the row numbers go, while they are few enough, so that only
    the rows it names are shuffled; beyond that it is a plain join.
    """
    n, total = few.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    if total <= FEW_BYTES:
        return rows.join(F.broadcast(few), row, "left")
    if 16 * n > FEW_BYTES:
        return rows.join(few, row, "left")
    named = F.broadcast(few.select(row))
    return rows.join(named, row, "left_anti").unionByName(
        rows.join(named, row, "left_semi").join(few.hint("merge"), row), allowMissingColumns=True
    )


def without_few(rows: DataFrame, few: DataFrame, row: str) -> DataFrame:
    """``rows`` but those numbered in the stored table ``few``; shuffled only where that is too large."""
    few = few.select(row)
    return rows.join(F.broadcast(few) if 16 * few.count() <= FEW_BYTES else few, row, "left_anti")


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The white-space separated words of a batch of texts.

    Returns the bounds of each text among the words, every word as a position
    in the list of distinct words, and that list.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return list_codes(pc.ascii_split_whitespace(pc.fill_null(texts, "")))


def list_codes(split: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """As ``word_codes``, for texts that are lists of words already; empty words go."""
    bounds = split.offsets.to_numpy().astype(np.int64)
    values = split.values.slice(bounds[0], bounds[-1] - bounds[0])
    coded = values.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    distinct = coded.dictionary.to_pylist()
    bounds = bounds - bounds[0]
    if "" in distinct:  # white space at either end of a text gives an empty word
        empty = distinct.index("")
        real = codes != empty
        before = np.concatenate(([0], np.cumsum(real)))
        codes, bounds = codes[real], before[bounds]
    return bounds, codes, distinct


class Recent:
    """A look-up of bounded size that forgets what was not used for longest.

    Two dictionaries: when the newer is full it becomes the older one, and what
    is used again moves to the newer. A worker keeps it between tasks; it only
    saves time and never changes a result.
    """

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def look_up(self, keys: list[str], make: Callable[[list[str]], list]) -> list:
        found = list(map(self.new.get, keys))
        missing = [i for i, v in enumerate(found) if v is None]
        if not missing:
            return found
        unknown = []
        for i in missing:
            v = self.old.get(keys[i])
            if v is None:
                unknown.append(i)
            else:
                found[i] = v
        for i, v in zip(unknown, make([keys[i] for i in unknown])):
            found[i] = v
        if len(self.new) + len(missing) > self.limit:
            self.old, self.new = self.new, {}
        self.new.update((keys[i], found[i]) for i in missing[: self.limit])
        return found


def laid_out(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of all parts (``width`` bytes each) end to end, where each part starts, and its size."""
    flat = np.frombuffer(b"".join(parts), dtype=f"<u{width}")
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // width
    return flat, np.cumsum(sizes) - sizes, sizes


def taken_parts(
    layout: tuple[np.ndarray, np.ndarray, np.ndarray], codes: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The values of the parts ``codes`` in this order, and their bounds per text."""
    flat, starts, sizes = layout
    taken = sizes[codes]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[codes] - (ends - taken), taken) + np.arange(total)
    return flat[at], np.concatenate(([0], ends))[bounds]


def joined(parts: list[bytes], codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``parts[codes]``: the values (``width`` bytes each) and their bounds per text."""
    return taken_parts(laid_out(parts, width), codes, bounds)


# A letter, marks, white space or the end. Only letters that stay one letter when
# lowered and composed: behind others (I with a dot, letters of scripts whose
# marks come apart) the splitter joins what follows to their own mark.
MARKS = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{400}-\x{481}])([.,;:!?#$%&*]+)([\t\n\r ]|$)"

# Letters that stay as they are when lowered and composed, and are one word to the splitter.
PLAIN = re.compile("[a-zß-öø-ÿ]+")

_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of whole texts for a tokenizer that encodes each word by itself.

    Holds for a vocabulary whose normaliser and splitter never join characters
    across ASCII white space, and lowers letters. Every distinct word is encoded by the library
    once and remembered; the tests compare the ids with those of whole texts.
    """

    LIMIT = 250_000
    RUN = 1000

    def __init__(self, path: str, limit: int | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known = Recent(limit or self.LIMIT)
        self.parting = self._parting_word(vocabulary)
        self.model, self.as_bytes = self.tokenizer.model, self._byte_names()
        self.direct = self._reads_plain_words(vocabulary)
        give_back()  # what reading the vocabulary took

    @classmethod
    def at(cls, path: str, limit: int | None = None) -> "WordEncoder":
        """This worker's encoder for a vocabulary file, which remembers twice ``limit`` words."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path, limit)
        encoder = _ENCODERS[path]
        if encoder.known.limit != (limit or cls.LIMIT):
            encoder.known = Recent(limit or cls.LIMIT)
        return encoder

    def _parting_word(self, vocabulary: dict[str, int]) -> tuple[str, int] | None:
        """The rarest word of plain letters that is one token, and its id."""
        words = ((t[:-4], i) for t, i in vocabulary.items() if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha())
        for word, i in sorted(words, key=lambda x: -x[1])[:100]:
            if self.tokenizer.encode(word, add_special_tokens=False).ids == [i]:
                return word, i
        return None

    def _byte_names(self) -> dict[int, str]:
        """How the model writes the plain letters that take two bytes."""
        from tokenizers import pre_tokenizers

        name = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {i: name(chr(i))[0][0] for i in range(0xDF, 0x100) if PLAIN.fullmatch(chr(i))}

    def _reads_plain_words(self, vocabulary: dict[str, int]) -> bool:
        """Whether the model alone gives the ids of words of plain letters: tried on
        all letters, in runs of every second and third, and on words of the vocabulary."""
        letters = "".join(filter(PLAIN.fullmatch, map(chr, range(0x100))))
        tried = [*letters, *(letters[i : i + 9 * k : k] for k in (1, 2, 3) for i in range(len(letters)))]
        tried += list(filter(PLAIN.fullmatch, (t.removesuffix("</w>") for t in sorted(vocabulary)[:2000] if t.isascii())))
        return self._by_model(tried) == self._one_by_one(tried)

    def _by_model(self, words: list[str]) -> list[bytes]:
        """Words of plain letters, which need neither normaliser nor splitter."""
        tokens, names = self.model.tokenize, self.as_bytes
        return [array("I", [t.id for t in tokens(w if w.isascii() else w.translate(names))]).tobytes() for w in words]

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _parted(self, words: list[str]) -> list[bytes]:
        """Words of any kind, many at a time: one rare word stands between them,
        and the count of its id confirms that none of them holds it."""
        if self.parting is None:
            return self._one_by_one(words)
        (between, i), values = self.parting, []
        for at in range(0, len(words), self.RUN):
            run = words[at : at + self.RUN]
            text = f" {between} ".join(run)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == i)
            if len(cuts) == len(run) - 1:
                raw, starts, ends = ids.tobytes(), [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), 4 * len(ids)]
                values += [raw[a:b] for a, b in zip(starts, ends)]
            else:
                values += self._one_by_one(run)
        return values

    def _make(self, new: list[str]) -> list[bytes]:
        """Words of plain letters go to the model, others through the whole library."""
        if not self.direct:
            return self._by_run(new)
        plain = list(map(PLAIN.fullmatch, new))
        words = iter(self._by_model(list(compress(new, plain))))
        others = iter(self._by_run([w for w, x in zip(new, plain) if not x]))
        return [next(words) if x else next(others) for x in plain]

    def _by_run(self, new: list[str]) -> list[bytes]:
        """Runs of letters are encoded many at a time: each is one word of the
        vocabulary's splitter and ends in one word-end token, which the count
        of these tokens confirms."""
        letters = list(map(str.isalpha, new))
        names, values = list(compress(new, letters)), []
        for at in range(0, len(names), self.RUN):
            run = names[at : at + self.RUN]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(run)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) == len(run):
                raw, b = ids.tobytes(), [0, *cuts.tolist()]
                values += [raw[i:j] for i, j in pairwise(b)]
            else:
                values += self._one_by_one(run)
        others = iter(self._parted([w for w, plain in zip(new, letters) if not plain]))
        plain = iter(values)
        return [next(plain) if x else next(others) for x in letters]

    def look_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The bounds of each text among the words of a batch, every word as a position
        in a list of distinct words, and the ids of those."""
        texts = pc.fill_null(texts, "")
        # Special tokens are found as they are written, before letters are lowered.
        special = pc.match_substring(texts, "<|")
        texts = pc.if_else(special, texts, pc.ascii_lower(texts))
        # Marks between a letter and white space are words of their own to the
        # splitter: apart from the letters there are fewer distinct words.
        texts = pc.replace_substring_regex(texts, MARKS, r"\1 \2\3")
        bounds, codes, distinct = word_codes(texts)
        return bounds, codes, self.known.look_up(distinct, self._make)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, and the bounds of each text among them."""
        bounds, codes, parts = self.look_up(texts)
        return joined(parts, codes, bounds, 4)

    def encode_pieces(self, texts: pa.Array, kind: str, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """As ``encode``, the words of the whole batch looked up at once and ids of ``kind`` made
        for about ``most`` words at a time: first and last text (exclusive), ids, bounds."""
        bounds, codes, parts = self.look_up(texts)
        flat, starts, sizes = laid_out(parts, 4)
        layout = flat.astype(kind), starts, sizes
        for a, b in pieces(np.diff(bounds), most):
            yield a, b, *taken_parts(layout, codes[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut rows of these sizes into runs of about ``most`` in all (one row at least)."""
    piece = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
    return ((a, b) for a, b in pairwise(cuts) if b > a)


def small_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``most`` bytes (one text at least)."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64)
        for a, b in pieces(sizes, most):
            yield batch.slice(a, b - a)


def forget_words() -> None:
    """Drop the encoders of former stages from this worker, which stays for later ones."""
    if _ENCODERS:
        _ENCODERS.clear()
        give_back()


def frugal(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``work`` over batches; what it held goes back to the system when its task ends.

    Workers stay for later stages, and both Arrow and the C library would keep
    freed memory for them.
    """

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return run


def give_back() -> None:
    """Hand memory that is free to the system: workers stay, and others need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def stars(edges: DataFrame) -> bool:
    """Whether every ``a`` of the distinct edges (a, b) has one edge and none of the ``b`` is an ``a``."""
    ends = edges.select("a", F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("up")))
    each = ends.groupBy("a").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return not each.agg(F.max(F.expr("ups > 1 or (ups = 1 and low = 0)")).alias("other")).first()["other"]


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, root), root the smallest node reachable.

    Alternating large-star and small-star steps: each is one aggregate and one
    join by node, so a node of any degree is a skewed join that adaptive
    execution splits, never one task's group. Every round is stored, so a lost
    executor costs one round. Rounds end once the edges are stars around the
    roots, which one aggregate tells: no round runs just to change nothing.
    Nodes without an edge do not appear; null ends and self-links are dropped.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    current = work.write(edges.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct(), f"{name}-0")
    for step in range(1, 100):
        if stars(current):
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = work.write(large, f"{name}-{step}-large")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        current = work.write(small, f"{name}-{step}")
        work.discard(f"{name}-{step - 1}")
        work.discard(f"{name}-{step}-large")
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return work.write(current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), f"{name}-roots")
