"""Runs of words against a direct search, and the query against its definition."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import periods
from starloom.llm.queries import op11_lyndon_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct_runs(words):
    """Every run by trying all periods."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(
                s <= i and i + (j - i + q) <= s + length and q % p == 0 for (s, p), length in found.items()
            ):
                found[(i, q)] = j - i + q
            i = j
    return [(s, length, q) for (s, q), length in sorted(found.items())]


def longest_lyndon(codes):
    n, out = len(codes), []
    for i in range(n):
        j = i + 1
        while j < n and codes[j:] > codes[i:]:
            j += 1
        out.append(j - i)
    return out


def some_words(rng):
    """Words with nested, touching and near repeats."""
    words = []
    for _ in range(rng.integers(1, 8)):
        root = rng.integers(0, rng.integers(1, 5), rng.integers(1, 9)).tolist()
        root = (root * int(rng.integers(1, 4)))[: int(rng.integers(1, 20))]
        words += root * int(rng.integers(1, 9)) + root[: int(rng.integers(0, len(root) + 1))]
        if rng.random() < 0.4:
            words += rng.integers(0, 40, rng.integers(0, 9)).tolist()
    return words


def test_lyndon_array():
    rng = np.random.default_rng(1)
    for _ in range(400):
        codes = some_words(rng)
        assert periods.lyndon_array(codes) == longest_lyndon(codes)
        turned = [-c for c in codes]
        assert periods.lyndon_array(turned) == longest_lyndon(turned)


def test_collapse_equals_direct_search():
    rng = np.random.default_rng(2)
    texts = [some_words(rng) for _ in range(600)] + [[], [0], [3] * 6, [3] * 5, [1, 2] * 4, [1, 2] * 3 + [1]]
    joined = [" ".join(f"w{c}" for c in words) for words in texts]
    counts, runs, collapsed = periods.collapse(pa.array(["\n\t" + t + " " for t in joined] + [None]))
    found = 0
    for words, n, got, left in zip([*texts, []], counts, runs.to_pylist(), collapsed.to_pylist()):
        want = direct_runs(words)
        assert [tuple(r.values()) for r in got] == want and n == len(words)
        gone = {i for s, length, q in want for i in range(s + q, s + length)}
        assert left == " ".join(f"w{c}" for i, c in enumerate(words) if i not in gone)
        found += len(want)
    assert found > 500


def test_long_text_is_linear():
    text = " ".join(["a"] * 100_000 + [f"w{i % 977}" for i in range(300_000)])
    _, runs, left = periods.collapse(pa.array([text]))
    assert [tuple(r.values()) for r in runs[0].as_py()] == [(0, 100_000, 1), (100_000, 300_000, 977)]
    assert len(left[0].as_py().split()) == 978


def planted(doc, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.fixture
def rows():
    rng = np.random.default_rng(5)
    out = [(i, " ".join(f"w{c}" for c in some_words(rng))) for i in range(120)]
    out += [(7, "x  y\tz " * 30), (None, "p q " * 9), (None, None), (40, ""), (40, ""), (41, " \n\x0b "), (42, "é ü " * 5)]
    return out


def test_query_equals_definition(spark, rows, tmp_path):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' AS runs", "'own' AS n_words")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, op11_lyndon_runs(spark, str(tmp_path)).collect()))
    want = []
    for doc, text in rows:
        words = planted(doc, text)
        runs = direct_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)]
        s, length, q = best or (None, None, None)
        from pyspark.sql import Row

        want.append(str(Row(doc_id=doc, n_runs=len(runs), start=s, length=length, period=q,
                            exponent_milli=best and 1000 * length // q, runs_sha256=sha[0], collapsed_sha256=sha[1])))
    assert got == sorted(want)


def test_empty_table_and_clashing_names(spark):
    none = spark.createDataFrame([], "text string, runs string, collapsed string, n_words string")
    found = periods.runs(none)
    assert found.columns[4:] == ["_n_words", "_runs", "_collapsed"] and found.count() == 0
    some = spark.createDataFrame([("a b " * 4, "own", "own", "own")], none.schema)
    row = periods.runs(some).first()
    assert row["runs"] == "own" and row["_collapsed"] == "a b" and row["_n_words"] == 8
