"""The queries of this package over the test tables, and their results in SQL where it has any."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm import (
    bpe_automaton,
    decontamination,
    hard_negatives,
    jaccard_join,
    licenses,
    line_dedup,
    quality_crf,
    quality_rules,
    resampling,
    secret_scan,
    substring_dedup,
    token_counts,
    warc,
)
from saleslake.llm.oracles import ORACLES as ORACLES
from saleslake.llm.tables import scratch, stored

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of the ids and of the decoded text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe_automaton.encode(documents, vocabulary_path()).drop("text")
    return bpe_automaton.decode(encoded, vocabulary_path()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 100 bytes cover which also start earlier."""
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark passages, and the items that occur."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_items(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op4_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of the ids is held out from training."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_crf.fit(documents, table(spark, sf_dir, "labels"))
    return quality_crf.score(documents, model).select(
        "doc_id",
        quality_crf.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the line-first rules for every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(documents).drop("text", "cleaned")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that are similar to no earlier line, and a digest of what stays."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or that of its directory.

    Documents lie in ``source/thousand/fifty``; every 50th of them lies one level up, every
    1,000th two. Any document with a licence line of its own licenses its directory.
    """
    i = F.col("doc_id")
    deep = F.concat_ws("/", "source", F.floor(i / 1000).cast("string"), F.floor(i / 50).cast("string"), i.cast("string"))
    middle = F.concat_ws("/", "source", F.floor(i / 1000).cast("string"), i.cast("string"))
    high = F.concat_ws("/", "source", i.cast("string"))
    path = F.when(i % 1000 == 0, high).when(i % 50 == 0, middle).otherwise(deep)
    files = table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    found = stored(licenses.own_licences(files).drop("text"))
    similarity = F.rint(F.col("similarity") * 1e6) / 1e6
    return licenses.inherit(found, any_file=True).withColumn("similarity", similarity)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in a ZIP package, read back by ranges."""
    pages = warc.classify(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    packages = stored(warc.write_packages(pages, scratch(spark)))
    return warc.read_packages(packages, payloads=False).drop("url")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether it is over the limit of 1,024."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = documents.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return token_counts.count_tokens(sized, vocabulary_path()).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a Jaccard similarity of 0.9 or more of their 3-word shingles."""
    return jaccard_join.join_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every 7th has the label after its own."""
    i, label = F.col("vec_id"), F.col("label")
    shifted = F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", shifted.alias("label"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


def _listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and a digest of the pattern matches, and all spans."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(documents).select("doc_id", "secrets")
    base = secret_scan.KINDS[:3]

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    listed = _listed(F.filter("secrets", lambda s: s["kind"].isin(base)))
    return found.select("doc_id", *map(count, base), F.sha2(listed, 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank in the draw of every document, with the benchmark as the target."""
    documents, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ranked = resampling.draw(resampling.score(documents, target))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    "op1_bpe_encode_decode": op1_bpe_encode_decode,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_quality_crf": op4_quality_crf,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_warc": op8_warc,
    "op9_token_counts": op9_token_counts,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_secret_scan": op12_secret_scan,
    "op13_importance_resampling": op13_importance_resampling,
}
