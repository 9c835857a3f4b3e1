"""Language identification by interpolated Kneser-Ney character models.

Texts are read as words of letters in lower case between boundary marks. Every
language with labelled texts has a model of order four: a letter's probability
after three others is its discounted count, and the mass that discounting frees
goes to the next shorter context, whose counts are the numbers of distinct
letters seen in front. The discounted parts and the freed masses of all
languages lie in arrays sorted by a 64-bit hash of the letters, one row per
context, one column per language, found by binary search.

A text belongs to the language with the lowest cross-entropy per letter. It is
rejected if that exceeds a limit calibrated per language on the labelled texts:
their median plus six robust standard deviations, one and a quarter bits at
least, plus a share that shrinks with the root of the text's length.

Counts come from all labelled texts, and every letter group is kept, however
rare. The models are stored tables. While their size, known from the counts, is
within ``CELLS`` numbers they go to all tasks as the sorted arrays; larger ones
stay where they are: the distinct four-letter windows of the texts meet them by
shuffles on the letters, order by order, and only windows too rare for the
arrays are shuffled from the texts. Both ways give the same figures but for the
last of 32 bits.

Defined results: texts that are null or without a letter are ``und``, score 0,
rejected; without labelled texts all are ``und``; equal cross-entropies go to
the first language by name; repeated rows count as often as they occur; extra
columns that are named like a result give way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Recent, forget_words, free_name, frugal, numbered, small_batches, word_codes
from starloom.sources.workspace import Workspace

ORDER = 4
UNKNOWN = "und"
ROBUST_DEVIATIONS = 6
LEAST_MARGIN = 1.25
SHORT_TEXT_BITS = 12.0
START, END = 2, 3
# What a task holds at once: text bytes, letters of new words, counted groups.
BATCH_BYTES = 1 << 22
LETTERS = 1 << 17
HELD_ROWS = 1_000_000
RARE_ROWS = 1 << 17
# Numbers (letter groups times languages) that may go to all tasks.
CELLS = 1 << 24
LOW = (1 << 21) - 1  # the lower of two letters packed in one number
RESULTS = ("pred", "score", "entropy", "n_letters")
RUN = re.compile(r"[^\W\d_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit number per row of character numbers."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        out = (out ^ c.astype(np.uint64)) * MIX
        out ^= out >> np.uint64(29)
    return out


def letters(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Every letter with the three before it, and the word it belongs to.

    Returns ORDER arrays of character numbers, oldest first. Words stand
    between boundary marks; the closing mark is predicted like a letter.
    """
    parts, sizes = [], []
    pad, end = chr(START) * (ORDER - 1), chr(END)
    for word in words:
        if word.isalpha():
            runs = [word]
        else:
            runs = RUN.findall(word)
            if not all(map(str.isalpha, runs)):
                runs = "".join(c if c.isalpha() else " " for r in runs for c in r + " ").split()
        n = 0
        for run in runs:
            parts.append(pad + run + end)
            n += len(run) + 1
        sizes.append(n)
    text = "".join(parts)
    numbers = np.frombuffer(text.encode("utf-32-le"), "<u4")
    at = np.flatnonzero(numbers != START)
    return [numbers[at - k] for k in range(ORDER - 1, -1, -1)], np.repeat(np.arange(len(words)), sizes)


def slices(words: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds that cut ``words`` into runs of about LETTERS letters, one word at least."""
    run = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) - 1) // LETTERS
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(words)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, hi, lo, n): how often each group of four occurs per language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, ...]]] = {}
        merged_rows = new_rows = 0

        def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
            hi, lo, n = (np.concatenate(x) for x in zip(*parts))
            _, first, inverse = np.unique(_hash([hi, lo]), return_index=True, return_inverse=True)
            return hi[first], lo[first], np.bincount(inverse, n).astype(np.int64)

        for batch in small_batches(batches, "text", BATCH_BYTES):
            langs = batch.column("lang").to_pylist()
            bounds, codes, distinct = word_codes(_lowered(batch.column("text")))
            weights = {}
            for lang in sorted(set(langs)):
                mine = np.repeat([x == lang for x in langs], np.diff(bounds))
                weights[lang] = np.bincount(codes[mine], minlength=len(distinct))
            for at, end in slices(distinct):
                parts, word = letters(distinct[at:end])
                hi = parts[0].astype(np.int64) << 21 | parts[1]
                lo = parts[2].astype(np.int64) << 21 | parts[3]
                for lang, of_words in weights.items():
                    weight = of_words[at:end][word]
                    some = weight > 0
                    found = merged([(hi[some], lo[some], weight[some])])
                    held.setdefault(lang, []).append(found)
                    new_rows += len(found[0])
                if new_rows > max(HELD_ROWS // 4, merged_rows):
                    held = {lang: [merged(x)] for lang, x in held.items()}
                    merged_rows, new_rows = sum(len(x[0][0]) for x in held.values()), 0
                if merged_rows > HELD_ROWS:
                    for lang, x in held.items():
                        yield rows(lang, *x[0])
                    held, merged_rows = {}, 0
        for lang, x in held.items():
            yield rows(lang, *merged(x))

    def rows(lang: str, hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([lang] * len(n), pa.string()), pa.array(hi), pa.array(lo), pa.array(n)], names=["lang", "hi", "lo", "n"]
        )

    counted = docs.select("text", "lang").mapInArrow(frugal(count), "lang string, hi bigint, lo bigint, n bigint")
    return counted.groupBy("lang", "hi", "lo").agg(F.sum("n").alias("n"))


@dataclass
class Trained:
    """All languages' models as stored tables; languages are numbered k by name."""

    languages: list[str]
    grams: list[DataFrame]  # order 1 first: hi, lo, k, part
    contexts: list[DataFrame]  # order 2 first: c1, c2, k, freed
    floor: np.ndarray  # probability of a letter never seen
    groups: int  # rows of all grams

    @property
    def cells(self) -> int:
        """No fewer numbers than the sorted arrays of the grams hold."""
        return self.groups * len(self.languages)


@dataclass
class Models:
    """All languages' models: per order sorted hashes with discounted parts, per context freed masses."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]  # order 1 first: hashes, [row, language]
    contexts: list[tuple[np.ndarray, np.ndarray]]  # order 2 first: hashes of contexts, freed mass
    floor: np.ndarray  # probability of a letter never seen

    def logs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per word and language the bits of its letters, and how many are predicted."""
        parts, word = letters(words)
        p = self.floor + self._found(*self.grams[0], _hash(parts[-1:]), 0.0)
        for order in range(2, ORDER + 1):
            own = parts[-order:]
            p = self._found(*self.grams[order - 1], _hash(own), 0.0) + p * self._found(
                *self.contexts[order - 2], _hash(own[:-1]), 1.0
            )
        bits = -np.log2(p)
        n = np.bincount(word, minlength=len(words))
        sums = [np.bincount(word, bits[:, k], minlength=len(words)) for k in range(len(self.languages))]
        return np.stack(sums, axis=1), n

    @classmethod
    def of(cls, trained: Trained) -> "Models":
        """The sorted arrays of stored models, brought to the driver."""
        width, grams, contexts = len(trained.languages), [], []
        for order, table in enumerate(trained.grams, 1):
            hi, lo, k, part = (c.to_numpy() for c in table.select("hi", "lo", "k", "part").toArrow().columns)
            grams.append(_table(_hash(_chars(hi, lo)[ORDER - order :]), k, part, width, 0.0))
        for order, table in enumerate(trained.contexts, 2):
            c1, c2, k, freed = (c.to_numpy() for c in table.select("c1", "c2", "k", "freed").toArrow().columns)
            contexts.append(_table(_hash([c1 >> 21, c1 & LOW, c2][ORDER - order :]), k, freed, width, 1.0))
        return cls(trained.languages, grams, contexts, trained.floor)

    @staticmethod
    def _found(hashes: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        out = values[at].astype(np.float64)
        out[hashes[at] != wanted] = otherwise
        return out


def _chars(hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    return [hi >> 21, hi & LOW, lo >> 21, lo & LOW]


def _last(order: int) -> list[Column]:
    """The packed last ``order`` letters of a window (hi, lo)."""
    zero = F.lit(0).cast("bigint")
    hi = {ORDER: F.col("hi"), ORDER - 1: F.col("hi").bitwiseAND(F.lit(LOW))}.get(order, zero)
    lo = F.col("lo").bitwiseAND(F.lit(LOW)) if order == 1 else F.col("lo")
    return [hi.cast("bigint").alias("hi"), lo.cast("bigint").alias("lo")]


def train(docs: DataFrame, work: Workspace) -> Trained | None:
    """Models of every language that ``docs`` (text, lang) has letters for."""
    table = work.write(gram_counts(docs), "grams-4")
    # A shorter group counts the distinct letters seen in front of it.
    shorter = [table]
    for order in range(ORDER - 1, 0, -1):
        cut = shorter[-1].select("lang", *_last(order)).groupBy("lang", "hi", "lo").agg(F.count("*").alias("n"))
        shorter.append(work.write(cut, f"grams-{order}"))
    grams, contexts, floor, groups, languages = [], [], None, 0, []
    for order, counts in zip(range(1, ORDER + 1), reversed(shorter)):
        ones = {r["lang"]: r for r in counts.groupBy("lang").agg(
            F.sum("n").alias("total"), F.count(F.when(F.col("n") == 1, 1)).alias("n1"), F.count(F.when(F.col("n") == 2, 1)).alias("n2"),
            F.count("*").alias("kinds")
        ).collect()}
        languages = sorted(ones)
        if not languages:
            return None
        groups += sum(r["kinds"] for r in ones.values())
        discount = [ones[x]["n1"] / max(ones[x]["n1"] + 2 * ones[x]["n2"], 1) or 0.5 for x in languages]
        facts = docs.sparkSession.createDataFrame(
            [(x, k, d) for k, (x, d) in enumerate(zip(languages, discount))], "lang string, k int, d double"
        )
        # The context is all but the last letter. One row per language: always small enough to send everywhere.
        own = counts.join(F.broadcast(facts), "lang").select("k", "d", "hi", "lo", "n", F.col("hi").alias("c1"), F.shiftright("lo", 21).alias("c2"))
        sums = own.groupBy("k", "d", "c1", "c2").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        part = (F.col("n") - F.col("d")) / F.col("total")
        grams.append(work.write(own.join(sums.drop("d"), ["k", "c1", "c2"]).select("hi", "lo", "k", part.alias("part")), f"parts-{order}"))
        if order == 1:
            most = max(r["kinds"] for r in ones.values()) + 1
            floor = np.array([d * ones[x]["kinds"] / ones[x]["total"] / most for x, d in zip(languages, discount)])
        else:
            # What the discounts of a context's groups leave goes to the shorter one.
            freed = F.greatest(F.col("d") * F.col("kinds") / F.col("total"), F.lit(1e-6))
            contexts.append(work.write(sums.select("c1", "c2", "k", freed.alias("freed")), f"freed-{order}"))
    return Trained(languages, grams, contexts, np.maximum(floor, 1e-9), groups)


def _table(key: np.ndarray, lang: np.ndarray, value: np.ndarray, width: int, empty: float) -> tuple[np.ndarray, np.ndarray]:
    hashes, row = np.unique(key, return_inverse=True)
    values = np.full((len(hashes), width), empty, np.float32)
    values[row, lang] = value
    return hashes, values


def window_bits(windows: DataFrame, trained: Trained, work: Workspace) -> DataFrame:
    """(hi, lo, bits): per language the bits of the last letter of every distinct window.

    Every order's probabilities are joined to the next one's groups by their
    letters, so a task holds neither a model nor a language's groups.
    """

    def by_language(table: DataFrame, value: str, *key: str) -> DataFrame:
        # At most one entry per language.
        return table.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("k", value))).alias(value))

    level = None
    for order in range(1, ORDER + 1):
        own = windows.select(*_last(order)).distinct()
        own = own.join(by_language(trained.grams[order - 1], "part", "hi", "lo"), ["hi", "lo"], "left")
        found = lambda k: F.coalesce(F.try_element_at("part", k), F.lit(0.0))
        if order == 1:
            p = F.transform(F.array(*map(F.lit, trained.floor.tolist())), lambda x, k: x + found(k))
        else:
            hi, lo = _last(order - 1)
            freed = by_language(trained.contexts[order - 2], "freed", "c1", "c2")
            own = own.withColumns({"s1": hi, "s2": lo, "c1": F.col("hi"), "c2": F.shiftright("lo", 21)})
            own = own.join(level.select(F.col("hi").alias("s1"), F.col("lo").alias("s2"), "p"), ["s1", "s2"])
            own = own.join(freed, ["c1", "c2"], "left")
            p = F.transform("p", lambda x, k: found(k) + x * F.coalesce(F.try_element_at("freed", k), F.lit(1.0)))
        level = work.write(own.select("hi", "lo", p.alias("p")), f"level-{order}")
    return level.select("hi", "lo", F.transform("p", lambda x: -F.log2(x)).alias("bits"))


def _common(windows: DataFrame, bits: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and bits of the most frequent windows, at most ``most``."""
    kinds = windows.groupBy(F.floor(F.log2("n")).cast("int").alias("size")).agg(F.count("*").alias("kinds")).collect()
    least, room = 64, most
    for r in sorted(kinds, key=lambda r: -r["size"]):
        room -= r["kinds"]
        if room < 0:
            break
        least = r["size"]
    got = windows.filter(F.col("n") >= F.lit(float(2**least))).select("hi", "lo").join(bits, ["hi", "lo"]).toArrow()
    width = len(got.column("bits")[0]) if got.num_rows else 0
    hashes = _hash([got.column(c).to_numpy() for c in ("hi", "lo")])
    order = np.argsort(hashes)
    flat = got.column("bits").combine_chunks().flatten().to_numpy() if width else np.zeros(0)
    return hashes[order], flat.reshape(len(hashes), width)[order].astype(np.float32)


def _scored_apart(docs: DataFrame, trained: Trained, work: Workspace, text: str, others: list[str]) -> DataFrame:
    """As ``scored``, with models of any size."""
    width = len(trained.languages)
    rows, row = numbered(docs, work, "to-score")
    windows = work.write(gram_counts(rows.select(F.col(text).alias("text"), F.lit("").alias("lang"))), "windows")
    bits = window_bits(windows, trained, work)
    hashes, values = _common(windows, bits, CELLS // width)
    shared = docs.sparkSession.sparkContext.broadcast((hashes, values))

    def work_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_bits = shared.value
        names = ["row", "hi", "lo", "times", "sums", "letters"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int64()]

        def rest(n: int, *columns: pa.Array | None) -> pa.RecordBatch:
            return pa.record_batch([pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in small_batches(batches, "text", BATCH_BYTES // 4):
            ids, height = batch.column("row").to_numpy(), batch.num_rows
            bounds, codes, distinct = word_codes(_lowered(batch.column("text")))
            doc = np.repeat(np.arange(height), np.diff(bounds))
            sums, n = np.zeros((height, width)), np.zeros(height, np.int64)
            pairs, times = np.unique(codes * height + doc, return_counts=True)  # by word
            for at, end in slices(distinct):
                parts, word = letters(distinct[at:end])
                hi = parts[0].astype(np.int64) << 21 | parts[1]
                lo = parts[2].astype(np.int64) << 21 | parts[3]
                wanted = _hash([hi, lo])
                place = np.minimum(np.searchsorted(known, wanted), max(len(known) - 1, 0))
                hit = known[place] == wanted if len(known) else np.zeros(len(wanted), bool)
                a, b = np.searchsorted(pairs, [at * height, end * height])
                of_word, of_doc, often = pairs[a:b] // height - at, pairs[a:b] % height, times[a:b]
                size = end - at
                for k in range(width if hit.any() else 0):
                    own = np.bincount(word[hit], known_bits[place[hit], k], minlength=size)
                    sums[:, k] += np.bincount(of_doc, own[of_word] * often, minlength=height)
                n += np.bincount(of_doc, np.bincount(word, minlength=size)[of_word] * often, minlength=height).astype(np.int64)
                # The windows left over, once for every document that has their word.
                word, hi, lo = word[~hit], hi[~hit], lo[~hit]
                count = np.bincount(word, minlength=size)
                first = np.cumsum(count) - count
                each = count[of_word]
                run = (np.cumsum(each) - each) // RARE_ROWS
                cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
                for p, q in zip(cuts, cuts[1:]):
                    many = each[p:q]
                    pair = np.repeat(np.arange(p, q), many)
                    at_window = first[of_word[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
                    if len(pair):
                        yield rest(len(pair), ids[of_doc[pair]], hi[at_window], lo[at_window], often[pair], None, None)
            yield rest(height, ids, None, None, None, list(sums), n)

    schema = "row bigint, hi bigint, lo bigint, times bigint, sums array<double>, letters bigint"
    met = work.write(rows.select(F.col(row).alias("row"), F.col(text).alias("text")).mapInArrow(frugal(work_on), schema), "met")
    rare = met.filter("hi IS NOT NULL").join(bits, ["hi", "lo"])
    rare = rare.select("row", F.transform("bits", lambda x: x * F.col("times")).alias("sums"), F.lit(0).cast("bigint").alias("letters"))
    every = met.filter("hi IS NULL").select("row", "sums", "letters").unionByName(rare).groupBy("row").agg(
        F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(width)]).alias("sums"), F.sum("letters").alias("n")
    )
    each = every.select("row", "n", F.transform("sums", lambda x: x / F.greatest("n", F.lit(1))).alias("bits"))
    low = F.array_min("bits")
    total = F.aggregate("bits", F.lit(0.0), lambda s, x: s + F.pow(F.lit(2.0), low - x))
    name = F.element_at(F.array(*map(F.lit, trained.languages)), F.array_position("bits", low).cast("int"))
    none = F.col("n") == 0
    result = free_name(rows, "result_")
    figures = F.struct(
        F.when(none, UNKNOWN).otherwise(name).alias("pred"), F.when(none, 0.0).otherwise(1 / total).alias("score"),
        F.when(~none, low).alias("entropy"), F.col("n").alias("n_letters"),
    )
    judged = each.select(F.col("row").alias(row), figures.alias(result))
    return rows.select(row, *others).join(judged, row).select(*others, *[F.col(f"{result}.{c}").alias(c) for c in RESULTS])


def scored(docs: DataFrame, trained: Trained | None, work: Workspace, text: str = "text", keep: bool = False) -> DataFrame:
    """``docs`` with pred, score, entropy (bits per letter) and n_letters, without the column ``text`` unless ``keep``."""
    others = [c for c in docs.columns if (keep or c != text) and c.lower() not in RESULTS]
    schema = docs.select(*others).schema
    for name, kind in (("pred", "string"), ("score", "double"), ("entropy", "double"), ("n_letters", "long")):
        schema = schema.add(name, kind)
    if trained is None:
        none = F.lit(None).cast("double")
        return docs.select(*others, F.lit(UNKNOWN).alias("pred"), F.lit(0.0).alias("score"), none.alias("entropy"),
                           F.lit(0).cast("bigint").alias("n_letters"))
    if trained.cells > CELLS:
        return _scored_apart(docs, trained, work, text, others)
    models = Models.of(trained)
    # Plain values: a broadcast is read where the package need not be found.
    shared = docs.sparkSession.sparkContext.broadcast([getattr(models, f.name) for f in fields(models)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        own = Models(*shared.value)
        width = len(own.languages)
        known = Recent(100_000)

        def make(new: list[str]) -> list[bytes]:
            size, out = 4 * (width + 1), []
            for at, end in slices(new):
                bits, n = own.logs(new[at:end])
                both = np.concatenate((bits, n[:, None]), axis=1).astype("<f4").tobytes()
                out += [both[i : i + size] for i in range(0, len(both), size)]
            return out

        for batch in small_batches(batches, text, BATCH_BYTES):
            bounds, codes, distinct = word_codes(_lowered(batch.column(text)))
            table = np.frombuffer(b"".join(known.look_up(distinct, make)), "<f4").reshape(len(distinct), width + 1)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            sums = [np.bincount(doc, table[codes, k].astype(np.float64), minlength=batch.num_rows) for k in range(width + 1)]
            n = sums.pop()
            entropy = np.stack(sums, axis=1) / np.maximum(n, 1)[:, None]
            best = entropy.argmin(axis=1)
            low = entropy[np.arange(batch.num_rows), best]
            share = 1 / np.exp2(low[:, None] - entropy).sum(axis=1)
            none = n == 0
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in others),
                    pa.array([UNKNOWN if x else own.languages[b] for x, b in zip(none.tolist(), best.tolist())], pa.string()),
                    pa.array(np.where(none, 0.0, share)),
                    pa.array(low, mask=none),
                    pa.array(n.astype(np.int64)),
                ],
                names=[*others, "pred", "score", "entropy", "n_letters"],
            )

    return docs.select(*(others if text in others else [*others, text])).mapInArrow(frugal(score), schema)


def limits(found: DataFrame, lang: str) -> dict[str, float]:
    """Per language the entropy up to which long texts are accepted, from its labelled texts."""
    own = found.filter((F.col(lang) == F.col("pred")) & F.col("entropy").isNotNull())
    middle = {r[lang]: r["m"] for r in own.groupBy(lang).agg(F.percentile_approx("entropy", 0.5, 1000).alias("m")).collect()}
    away = F.lit(None).cast("double")
    for name, m in middle.items():
        away = F.when(F.col(lang) == name, F.abs(F.col("entropy") - m)).otherwise(away)
    spread = own.groupBy(lang).agg(F.percentile_approx(away, 0.5, 1000).alias("s")).collect()
    return {r[lang]: middle[r[lang]] + max(ROBUST_DEVIATIONS * 1.4826 * r["s"], LEAST_MARGIN) for r in spread}


def accepted(limit: dict[str, float]):
    """True where a scored text is within its language's limit."""
    most = F.lit(None).cast("double")
    for name, value in limit.items():
        most = F.when(F.col("pred") == name, F.lit(value)).otherwise(most)
    most = most + SHORT_TEXT_BITS / F.sqrt(F.greatest(F.col("n_letters"), F.lit(1)))
    return F.coalesce(F.col("entropy") <= most, F.lit(False))


def held_out(doc_id: str = "doc_id"):
    """The quarter of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, work: Workspace, lang: str = "lang") -> DataFrame:
    """``docs`` without text, with held_out, pred, score, entropy, n_letters and rejected, stored.

    Learns from the texts with a label that are not held out. ``docs`` needs
    doc_id, text and the label column.
    """
    learned = docs.filter(~held_out() & F.col(lang).isNotNull()).select("text", F.col(lang).alias("lang"))
    found = work.write(scored(docs.withColumn("held_out", held_out()), train(learned, work), work), "scored")
    limit = limits(found.filter("not held_out"), lang)
    return found.withColumn("rejected", ~accepted(limit))


def filtered(docs: DataFrame, work: Workspace, lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that are rejected."""
    learned = docs.filter(~held_out() & F.col(lang).isNotNull()).select("text", F.col(lang).alias("lang"))
    names = [f"column_{k}" for k in range(len(docs.columns))]
    plain = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], held_out().alias("held_out"))
    text = names[docs.columns.index("text")]
    found = work.write(scored(plain, train(learned, work), work, text, keep=True), "scored")
    label = names[docs.columns.index(lang)]
    limit = limits(found.filter("not held_out"), label)
    return found.filter(accepted(limit)).select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
