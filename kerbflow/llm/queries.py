"""Named queries over the given tables, one per operator, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.llm import oracle
from kerbflow.llm.chat import digest_conversations, format_conversations
from kerbflow.llm.decontaminate import find_leaks
from kerbflow.llm.embeddings import link_vectors
from kerbflow.llm.langid import held_out, identify_language, train
from kerbflow.llm.line_dedup import dedup_lines
from kerbflow.llm.minhash import near_duplicates
from kerbflow.llm.periodic_runs import periodic_runs
from kerbflow.llm.resampling import resample
from kerbflow.llm.secrets import scan_secrets, spans_text
from kerbflow.llm.sentencepiece_stream import encode_checked
from kerbflow.llm.token_blocks import read_token_files, write_token_files
from kerbflow.llm.token_counts import count_tokens
from kerbflow.llm.warc import plan_revisits, read_warc, write_warc
from kerbflow.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram pieces of every document."""
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, the base kinds counted and digested."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["rank"] < 3)
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives."""
    planned = plan_revisits(table(spark, sf_dir, "pages"))
    records = read_warc(write_warc(planned, scratch_dir(spark, "warc")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of every vector at a cosine of 0.95."""
    return link_vectors(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    encoded = encode_checked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written in blocks and read back from the files."""
    manifest = write_token_files(table(spark, sf_dir, "documents"), scratch_dir(spark, "token-files"))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, one row per document and item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def _classes(docs: DataFrame, **how) -> DataFrame:
    classes = near_duplicates(docs, **how)
    return classes.select(
        "doc_id", "class_id", F.col("class_rows").alias("class_size"), (F.col("row_key") == F.col("class_key")).alias("kept")
    )


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under links of a shingle similarity of 0.8 or more."""
    return _classes(table(spark, sf_dir, "documents"))


def minhash_dedup_by_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator with the counts of shingles as their weights: a text and its repetition are far apart."""
    return _classes(table(spark, sf_dir, "documents"), weighted=True, tasks=4 * spark.sparkContext.defaultParallelism)


#: A conversation that says the marks of the template itself.
MARKS = "\\### Assistant: </turn> ok"
MARKED_CONVERSATION = -7


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of the template's own marks, formatted in windows and read back from them."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    schema = T.StructType(
        [T.StructField(n, t) for n, t in (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))]
    )
    rows = [(MARKED_CONVERSATION, 0, "user", MARKS), (MARKED_CONVERSATION, 1, "assistant", MARKS)]
    return digest_conversations(format_conversations(turns.unionByName(spark.createDataFrame(rows, schema))))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document against the benchmark, and the rank of those drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that one of smaller id holds."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


WORD = r"[^\x20\x09-\x0D]+"


def repeated_in_part(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which about one text in ten repeats a part of its own from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    chosen = (h % 10 == 0) & (F.length(F.btrim("text", F.lit(" \t\n\x0b\f\r"))) > 0)
    part = docs.where(chosen).select("doc_id", words.alias("words"), g.alias("g"), F.size(words).alias("n"))
    part = part.select("*", (F.col("g") % F.col("n")).cast("int").alias("a"))
    part = part.select("*", (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int").alias("p"))
    a, p = F.col("a"), F.col("p")
    word = lambda i: F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p))
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), word), " ")
    return part.select("doc_id", again.alias("text")).unionByName(docs.where(F.coalesce(~chosen, F.lit(True))))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one text in ten made to repeat itself, and the digest of what is left without them."""
    docs = repeated_in_part(table(spark, sf_dir, "documents").select("doc_id", "text"))
    runs = F.col("found.runs")
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    more = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    found = periodic_runs(docs, to="found").select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        F.aggregate(runs, F.get(runs, F.lit(0)), more).alias("best"),
        F.sha2(F.array_join(F.transform(runs, line), ""), 256).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )
    milli = F.expr("best.length * 1000 div best.period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli, "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_secret_scan,
        op3_warc,
        op4_embedding_dedup,
        op5_language_id,
        op6_sentencepiece,
        op7_token_files,
        op8_decontamination,
        op9_minhash_dedup,
        minhash_dedup_by_counts,
        op10_chat_format,
        op11_importance_resampling,
        op12_line_dedup,
        op13_periodic_runs,
    )
}
SQL: dict[str, str] = dict(oracle.SQL)
