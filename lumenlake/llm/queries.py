"""One query per operator, over whole tables, with the contracts' columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenlake.llm import exact, itq, language, licenses, lines, mixing, pieces, runs, search, simhash, tokens, toxicity, warc
from lumenlake.llm.common import BLANKS, new_folder, remainder, text_or_empty

TOKEN_LIMIT = 512

REJECT = toxicity.REJECT


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs))
    held_out = (remainder(F.col("row.doc_id"), 4) == 2).alias("held_out")
    return found.select("row.doc_id", held_out, "lang_pred", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    held_out = (remainder(F.col("row.doc_id"), 3) == 1).alias("held_out")
    predicted = F.when(F.col("score") >= REJECT, 1).otherwise(0).alias("predicted")
    return found.select("row.doc_id", held_out, "score", predicted)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(_table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def token_digests(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(pieces.encode(_table(spark, sf_dir, "documents"), tokenizer_path()))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archives(warc.records(_table(spark, sf_dir, "pages")), folder)
    # Payloads of responses are inflated and held against their digests; revisits are taken from headers alone.
    responses = warc.read_archives(spark, folder, verify="true").where(F.col("record_type") == "response")
    revisits = warc.read_archives(spark, folder, payload="none").where(F.col("record_type") == "revisit")
    found = responses.unionByName(revisits)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = itq.near_duplicates(_table(spark, sf_dir, "embeddings"))
    return found


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: licenses in text order, known sentences, and those no rule claims."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "row.doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.size("sentences").cast("long").alias("n_sentences"),
        "n_unclaimed",
    )


def planted_runs(docs: DataFrame) -> DataFrame:
    """The documents; a tenth of them, by a hash of the id, repeat some of their words up to the end.

    Rows without an id stay as they are.
    """
    words = F.filter(F.split(text_or_empty(), BLANKS), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n = F.size("s.words")
    a = F.col("s.g") % n
    p = F.expr("1 + (size(s.words) - s.g % size(s.words)) div (3 + s.g % 8)")
    times = F.expr("(size(s.words) - s.g % size(s.words)) div (1 + (size(s.words) - s.g % size(s.words)) div (3 + s.g % 8)) + 1")
    again = F.flatten(F.array_repeat(F.slice("s.words", a + 1, p), times.cast("int")))
    planted = F.array_join(F.concat(F.slice("s.words", F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    chosen = docs.withColumn("s", F.when(h % 10 == 0, F.struct(words.alias("words"), F.floor(h / 10).alias("g"))))
    return chosen.withColumn("text", F.when(F.size("s.words") > 0, planted).otherwise(F.col("text"))).drop("s")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.find_runs(docs)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    every = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return found.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_mixing, op2_language, op3_toxicity, op4_simhash, op5_exact, op6_lines, op7_pieces, op8_warc, op9_itq,
        op10_licenses, op11_runs, op12_tokens, op13_search,
    )
}
