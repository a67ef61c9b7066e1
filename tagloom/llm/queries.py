"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import quality, toxicity
from tagloom.llm.common import table
from tagloom.llm.decontamination import contamination
from tagloom.llm.merkle import folded, manifest, proof_text
from tagloom.llm.ngram_join import jaccard_components
from tagloom.llm.periodic_runs import periodic_runs
from tagloom.llm.secret_scan import BASE, secret_spans, span_text
from tagloom.llm.sentencepiece import encode, model_bytes, tokenizer_path
from tagloom.llm.sharding import jump_shards
from tagloom.llm.stream_dedup import exact_duplicates
from tagloom.llm.substring_dedup import repeated_passages_removed
from tagloom.llm.topk import top_k
from tagloom.llm.warc import archive_folder, read_warc, write_warc


def held_out() -> Column:
    """The third of the documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document after disguised words are restored."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels, ~held_out(), sample_rows=20_000)
    scored = toxicity.score(documents, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "restored"
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in each document."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85).drop("text_hash")


def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of each document among 16, and among 17."""
    return jump_shards(table(spark, sf_dir, "documents"), shards=16)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold 10 consecutive words of benchmark items, and how much of them is to go."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), length=10)
    # Spans alternate first word and end: ends minus firsts.
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Ids of each document under the public BPE model with byte fallback, and what they decode to."""
    model = model_bytes(model_path or tokenizer_path("piece_bpe_32k.model"))
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model, decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("covered_bytes"),
    )


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.OrdinalModel:
    """Grades of the labels: 0 of low quality, 1 good but toxic, 2 good; learned off the held-out third."""
    rating = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2)
    return quality.fit(documents, labels, rating, n_grades=3, usable=~held_out(), sample_rows=4000)


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of each document and the probabilities of grade 1 or more and of grade 2."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    graded = quality.grade(documents, quality_model(documents, table(spark, sf_dir, "labels")))
    return graded.select(
        "doc_id", held_out().alias("held_out"), "expected_grade", F.col("tails")[0].alias("p_grade_1"), F.col("tails")[1].alias("p_grade_2"),
        (F.col("tails")[0] >= 0.5).alias("kept"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the passages of 35 words that occur elsewhere."""
    left = repeated_passages_removed(table(spark, sf_dir, "documents"), length=35, keep_text=False)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back, one row per record."""
    files = write_warc(table(spark, sf_dir, "pages"), archive_folder(spark))
    records = read_warc(files, payloads=False)
    number = F.nullif(F.split_part("record_id", F.lit(":"), F.lit(3)), F.lit("")).cast("long")
    return records.select(
        number.alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.split_part("refers_to", F.lit(":"), F.lit(3)).cast("long").alias("refers_to"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of each vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot and root of each document, and whether its tampered row still folds to the root."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proven = manifest(table(spark, sf_dir, "documents"), claimed={"text": tampered})
    back = folded(F.coalesce("claim", "leaf"), F.col("proof"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), back.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the documents with equal texts stays."""
    found = exact_duplicates(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def with_repetitions(documents: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document, by the checksum of its id, goes on repeating a stretch of its words."""
    rows = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.withColumn("words", F.when(F.expr("h % 10 = 0"), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    rows = rows.withColumn("a", F.expr("int(try_mod(h div 10, size(words)))"))
    rows = rows.withColumn("p", F.expr("1 + int((size(words) - a) div (3 + (h div 10) % 8))"))
    again = F.expr("array_join(transform(words, (w, i) -> CASE WHEN i < a THEN w ELSE words[a + (i - a) % p] END), ' ')")
    return rows.select("doc_id", F.when(F.expr("size(words) > 0"), again).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of each document, and what is left without their repetitions."""
    found = periodic_runs(with_repetitions(table(spark, sf_dir, "documents")), least=12, keep_text=False)
    # The longest run; of equally long ones the first, then that of the smaller period.
    best = F.expr("array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.sha2(listed, 256).alias("runs_sha256"), "collapsed_sha256", best.alias("best")
    ).select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (op1_toxicity, op2_secret_scan, op3_ngram_jaccard, op4_jump_shards, op5_decontamination, op6_sentencepiece, op7_ordinal_quality, op8_substring_dedup, op9_warc, op10_topk, op11_merkle_manifest, op12_stream_dedup, op13_periodic_runs)
}
