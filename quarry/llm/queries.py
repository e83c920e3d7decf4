"""One thin query per operator, with production parameters, over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm import (
    chat, decontaminate, hard_negatives, licenses, lines, nbsvm, neardup, oracles, packing, pii, prefix_trie, rules,
    secrets, toxicity,
)
from quarry.sources.tables import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark, folder):
    return licenses.report(licenses.scan(table(spark, folder, "documents")))


def op2_quality_rules(spark, folder):
    return rules.quality(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op3_quality_classifier(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return nbsvm.classify(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


def op4_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.classify(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


def op5_line_dedup(spark, folder):
    done = lines.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    runs = F.array_join(F.transform("line_runs", lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string"))), ",")
    return done.select("doc_id", F.size("line_runs").alias("n_runs"), runs.alias("runs"),
                       F.length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("text_sha256"))


def op6_secret_scan(spark, folder):
    findings, _ = secrets.scan(table(spark, folder, "documents"))
    return secrets.report(findings)


def op7_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def op8_near_duplicates(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op9_personal_data(spark, folder):
    return pii.report(pii.scan(table(spark, folder, "documents")))


def op10_decontamination(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_chat_format(spark, folder):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select(*[F.col(c).cast(t) for c, t in extra.dtypes]).unionByName(extra)
    return chat.read_back(chat.format_chats(chat.replies(rows))).withColumnRenamed("tree", "conv_id").drop("leaf")


def op12_hard_negatives(spark, folder):
    return hard_negatives.mine(hard_negatives.scaled_rows(table(spark, folder, "embeddings")), F.col("id") % 100 == 0)


def op13_prefix_trie(spark, folder):
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_packing": op7_packing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_personal_data": op9_personal_data,
    "op10_decontamination": op10_decontamination,
    "op11_chat_format": op11_chat_format,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}
# The others hold trained models or a tokenizer; tests/llm has them against brute force.
ORACLE: dict[str, str] = {
    "op5_line_dedup": oracles.LINES,
    "op6_secret_scan": oracles.SECRETS,
    "op8_near_duplicates": oracles.NEAR_DUPLICATES,
    "op10_decontamination": oracles.DECONTAMINATION,
    "op11_chat_format": oracles.CHAT_FORMAT,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}
