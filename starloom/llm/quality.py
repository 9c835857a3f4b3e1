"""Quality rules learned as an ordered decision list by sequential covering.

Each rule is a conjunction of thresholds on text statistics that marks low
quality. It is grown on two thirds of the labelled texts, one test at a time,
by information gain; it is pruned on the other third, by cutting last tests
while that helps; the texts it covers leave, and the next rule is grown on the
rest. The list ends when no rule is precise enough. It is emitted as one SQL
CASE expression, the rules in order, and applied to every text.

Training never moves texts: labelled statistics are cut at quantiles once, and
each step is one aggregate that returns a count per statistic and step.

Defined results: a null text has no words; it and all texts with fewer than 50
words, or with over half their words in repeated three-word windows, fail the
base test and are not kept; without usable labels the list is empty and the
base test decides alone; a document with several labels counts with each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import let, words
from starloom.sources.workspace import Workspace

LEAST_WORDS = 50
REPEAT_PERCENT = 50
STEPS = 32
MAX_RULES = 8
MAX_TESTS = 3
LEAST_PRECISION = 0.9
LEAST_COVER = 0.01
SYMBOLS = "[#*$%&|<>]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_caps_words", "n_lines", "n_marked_words")

# Statistics the rules test, as SQL over the counts.
STATISTICS = {
    "words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "caps_share": "n_caps_words / greatest(n_words, 1)",
    "marked_share": "n_marked_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}


def repeated_words(ws: Column) -> Column:
    """Words in three-word windows found twice or more, each word once."""

    def covered(places: Column) -> Column:
        """Lengths of the three-word stretches from sorted places, overlaps once."""
        step = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(3)), F.lit(3)))
        return F.aggregate(step, F.lit(0), lambda total, x: total + x)

    def found_twice(ordered: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(ordered, i)["h"] == F.get(ordered, j)["h"], F.lit(False))
        again = F.filter(ordered, lambda x, i: same(i, i + 1) | F.when(i > 0, same(i, i - 1)).otherwise(F.lit(False)))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def among(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeats = let(let(ordered, found_twice), covered)
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), repeats).otherwise(F.lit(0))

    windows = F.when(
        F.size(ws) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(windows, among)


def counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the counts of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).alias("n_words"),
            F.char_length(F.array_join(ws, "")).alias("word_chars"),
            repeated_words(ws).alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: (F.char_length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w)))).alias("n_caps_words"),
            F.size(F.filter(ws, lambda w: F.right(w, F.lit(2)).rlike(r"^[^\p{L}\p{N}]{2}$"))).alias("n_marked_words"),
        )

    def of_lines(lines: Column) -> Column:
        real = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(real, lambda r: F.struct(F.size(r).alias("n_lines"), (F.size(r) - F.size(F.array_distinct(r))).alias("n_dup_lines")))

    made = docs.select(
        *keep,
        let(words(text), of_words).alias("w"),
        let(F.split(text, "\n", -1), of_lines).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
    )
    fields = {"n_symbols": "n_symbols", "n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines"}
    return made.select(*keep, *[F.col(fields.get(c, f"w.{c}")).cast("bigint").alias(c) for c in COUNTS])


@dataclass(frozen=True)
class Test:
    """One threshold on a statistic."""

    statistic: str
    above: bool
    cut: float

    def sql(self) -> str:
        return f"({STATISTICS[self.statistic]}) {'>' if self.above else '<='} {self.cut!r}D"


Rule = tuple[Test, ...]


def rule_sql(rule: Rule) -> str:
    return " AND ".join(t.sql() for t in rule)


def list_sql(rules: list[Rule]) -> str:
    """The decision list as one expression: the number of the first rule that fits, or null."""
    whens = " ".join(f"WHEN {rule_sql(r)} THEN {k}" for k, r in enumerate(rules, 1))
    return f"CASE {whens} END" if rules else "CAST(NULL AS INT)"


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    """Information gained per low text that a test keeps, times their number."""
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(counted: DataFrame, labels: DataFrame, work: Workspace) -> list[Rule]:
    """Rules for quality 0 from ``labels`` (doc_id, quality)."""
    wanted = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    stats = [F.expr(sql).cast("double").alias(name) for name, sql in STATISTICS.items()]
    part = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 2).alias("pruning")
    rows = work.write(counted.join(wanted, "doc_id").select(part, (F.col("quality") == 0).alias("low"), *stats), "labelled")
    at = F.array(*[F.lit(k / STEPS) for k in range(1, STEPS)])
    quantiles = rows.agg(*[F.percentile_approx(s, at, 2000).alias(s) for s in STATISTICS]).first()
    cuts = {s: sorted(set(quantiles[s] or [])) for s in STATISTICS}
    # The step of a value: how many cuts lie below it.
    steps = [_step(s, cuts[s]) for s in STATISTICS]
    binned = work.write(rows.select("pruning", "low", *steps), "binned")
    names = list(STATISTICS)
    rules: list[Rule] = []
    left = binned
    least = LEAST_COVER * binned.filter("low and pruning").count()
    for _ in range(MAX_RULES):
        tests: list[Test] = []
        prefix: list[tuple[int, int]] = []  # low and other texts of the pruning part, after each test
        covered = left
        conditions: list[Column] = []
        for _ in range(MAX_TESTS):
            cells = F.explode(F.array(*[F.struct(F.lit(k).alias("s"), F.col(s).alias("step")) for k, s in enumerate(names)]))
            table = covered.select("pruning", "low", cells.alias("c")).groupBy("pruning", "low", "c.s", "c.step").count().collect()
            tally: dict[tuple, int] = {(r["pruning"], r["low"], r["s"], r["step"]): r["count"] for r in table}

            def held(pruning: bool, low: bool, s: int, steps: range, tally: dict = tally) -> int:
                return sum(tally.get((pruning, low, s, k), 0) for k in steps)

            every = range(STEPS + 1)
            p0, n0 = held(False, True, 0, every), held(False, False, 0, every)
            if not p0 or not n0:
                break
            best = (0.0, None)
            for s, name in enumerate(names):
                for k in range(len(cuts[name])):
                    for above in (True, False):
                        steps_in = range(k + 1, STEPS + 1) if above else range(k + 1)
                        p, n = held(False, True, s, steps_in), held(False, False, s, steps_in)
                        gain = _gain(p0, n0, p, n)
                        if gain > best[0]:
                            best = (gain, (s, k, above, steps_in))
            if best[1] is None:
                break
            s, k, above, steps_in = best[1]
            tests.append(Test(names[s], above, cuts[names[s]][k]))
            prefix.append((held(True, True, s, steps_in), held(True, False, s, steps_in)))
            own = F.col(names[s]) > k if above else F.col(names[s]) <= k
            conditions.append(own)
            covered = covered.filter(own)
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in prefix]
        if not worth:
            break
        keep = max(range(len(worth)), key=lambda i: (worth[i], -i))
        p, n = prefix[keep]
        if p < max(least, 1) or p < LEAST_PRECISION * (p + n):
            break
        rules.append(tuple(tests[: keep + 1]))
        fits = conditions[0]
        for c in conditions[1 : keep + 1]:
            fits = fits & c
        left = left.filter(~fits)
    return rules


def _step(name: str, cuts: list[float]) -> Column:
    total = F.lit(0)
    for cut in cuts:
        total = total + F.coalesce((F.col(name) > cut).cast("int"), F.lit(0))
    return total.alias(name)


def judge(docs: DataFrame, labels: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, the counts, base_failed, rule (the first that fits, or null) and kept."""
    counted = work.write(counts(docs), "counts")
    rules = learn(counted, labels, work)
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    judged = counted.withColumn("base_failed", failed).withColumn("rule", F.expr(list_sql(rules)).cast("int"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
