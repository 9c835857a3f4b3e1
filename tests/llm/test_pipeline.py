"""The pipeline's stages on a small table with planted copies and odd rows."""

from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import hamming


def clean_rows():
    """Unlike texts and near copies; some ids are null or shared."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    rows = []
    for i in range(24):
        doc_id = None if i % 4 == 0 else 7 if i % 4 == 1 else 100 + i
        text = rng.choice(words, 80).tolist()
        rows.append((doc_id, " ".join(text)))
        if i % 3 == 0:
            rows.append((200 + i, " ".join([*text[:-1], "ending"])))
    return rows


def brute_kept(rows):
    """Of every group of linked texts the row with the smallest doc_id, nulls last."""
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    return [rows[next(i for i in order if group[i] == g)] for g in set(group)]


def test_null_and_shared_ids_keep_unlike_texts(spark, work):
    rows = clean_rows()
    kept = hamming.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), work)
    assert Counter(map(tuple, kept.collect())) == Counter(brute_kept(rows))


def test_run_equals_brute_force_on_clean_texts(spark, tmp_path):
    rows = clean_rows()
    docs = [(i, t, "en", "s", len(t)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = Counter((i, len(tokenizer.encode(t, add_special_tokens=False).ids) + 1) for i, t in brute_kept(rows))  # and the end id
    assert Counter((r["doc_id"], r["length"]) for r in got) == want


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "z", 0), (9001, "", "en", "z", 0)], docs.schema)
    docs = docs.unionByName(extra)
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
        assert docs.columns == columns and 0.8 * n <= docs.count() <= n, name
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0


def test_python_gets_few_rows_at_once_and_the_session_keeps_its_setting(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda docs, *a, **k: seen.append((spark.conf.get(key), k["remember"])) or docs)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    corpus_pipeline.pack_sequences(spark, spark.createDataFrame([(1,) * 7], names), "")
    assert int(seen[0][0]) <= 1000 and seen[0][1] <= 1 << 16
    assert spark.conf.get(key) == before


def test_a_worker_remembers_as_many_words_as_the_stage_allows():
    import pyarrow as pa

    from starloom.llm import common

    encoder = common.WordEncoder.at(public_tokenizers.path(corpus_pipeline.VOCABULARY), 50)
    texts = pa.array([" ".join(f"word{i}" for i in range(k, k + 40)) for k in range(0, 400, 40)])
    few = [encoder.encode(texts.slice(i, 1))[0].tolist() for i in range(len(texts))]
    assert len(encoder.known.new) + len(encoder.known.old) <= 100
    many = common.WordEncoder.at(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    assert few == [many.encode(texts.slice(i, 1))[0].tolist() for i in range(len(texts))]
    common.forget_words()
    assert not common._ENCODERS
