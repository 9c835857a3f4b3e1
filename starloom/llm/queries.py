"""The dealt operators as registered queries, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    credentials,
    hamming,
    language,
    lines,
    mixing,
    neighbours,
    oracles,
    packing,
    periods,
    pieces,
    quality,
    shards,
    tokens,
    whitening,
)
from starloom.llm.common import let, words
from starloom.sources.workspace import Workspace

VOCABULARY = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark, "quality"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *base, "base_failed", "kept", "rule")


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.place(table(spark, sf_dir, "documents"), Workspace(spark, "shards"))
    none = F.lit(None).cast("int")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard"), "curve"
    )


def op3_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_repeats(table(spark, sf_dir, "documents"), Workspace(spark, "lines"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, Workspace(spark, "language"))
    return found.select("doc_id", "held_out", F.col("pred").alias("lang_pred"), "score", "rejected")


def op5_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.groups(table(spark, sf_dir, "embeddings"), Workspace(spark, "neighbours"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), Workspace(spark, "packing"), keep_ids=False
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_owned_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(table(spark, sf_dir, "documents"), Workspace(spark, "secrets"))


def op8_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECES)
    texts = pieces.decoded(pieces.encoded(table(spark, sf_dir, "documents"), model), model)
    crc = F.crc32(F.col("text").cast("binary"))
    return texts.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), crc.alias("decoded_crc32"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "tokens")
    files, ranks = tokens.write_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), work)
    read = tokens.read_files(spark, files, ranks)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_hamming_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = hamming.groups(docs, Workspace(spark, "hamming"), width=4)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents repeats its words from some place on.

    With h the crc32 of the id and g = h div 10, where h is a multiple of 10
    the n words from a = g mod n on become a[(i - a) mod p], with period
    p = 1 + (n - a) div (3 + g mod 8). A null id is left as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("g div 10")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = F.pmod(F.col("g"), n)
        p = F.floor((n - a) / (F.col("g") % 8 + 3)) + 1
        place = F.array(a, p)
        return let(place, lambda x: F.transform(w, lambda own, i: F.when(i < F.get(x, F.lit(0)), own).otherwise(
            F.get(w, (F.get(x, F.lit(0)) + (i - F.get(x, F.lit(0))) % F.get(x, F.lit(1))).cast("int")))))

    chosen = docs.select("doc_id", "text", h.alias("g")).withColumn("planted", F.expr("g % 10 = 0")).withColumn("g", g)
    again = let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")).otherwise(""))
    return chosen.select("doc_id", F.when(F.col("planted"), again).otherwise(F.col("text")).alias("text"))


def op11_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.runs(_with_planted_periods(table(spark, sf_dir, "documents")))
    # The exact greatest length / period; runs come by start and period, so the first of equal ones stays.
    better = lambda best, x: x["length"] * best["period"] > best["length"] * x["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, x: F.when(better(best, x), x).otherwise(best))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op12_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found, model = whitening.whiten(rows, Workspace(spark, "whitening"))
    n, explained, error = (model.n, model.explained.tolist(), model.identity_error) if model else (0, [], None)
    share = F.get(F.array(*[F.lit(e) for e in explained]).cast("array<double>"), F.col("pos"))
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "whitened")).select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def op13_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), Workspace(spark, "mixing"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_decision_list": op1_decision_list,
    "op2_hilbert_shards": op2_hilbert_shards,
    "op3_line_windows": op3_line_windows,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_flat_graph": op5_flat_graph,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_owned_secrets": op7_owned_secrets,
    "op8_piece_transducer": op8_piece_transducer,
    "op9_token_files": op9_token_files,
    "op10_hamming_groups": op10_hamming_groups,
    "op11_lyndon_runs": op11_lyndon_runs,
    "op12_polarised_whitening": op12_polarised_whitening,
    "op13_water_filling": op13_water_filling,
}

ORACLES = {
    "op3_line_windows": oracles.LINES,
    "op10_hamming_groups": oracles.GROUPS,
    "op13_water_filling": oracles.MIX,
}
