"""The registered queries of this package, and SQL for those that SQL can express."""

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    decontamination,
    filter_audit,
    language_id,
    packing,
    quality_rules,
    rule_ensemble,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    url_filter,
    vector_codes,
    warc_bundles,
)
from .rows import fold


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_secret_scan(spark, d):
    return secret_scan.scan_secrets(table(spark, d, "documents"))


def op2_decontamination(spark, d):
    spans = decontamination.contamination_spans(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return decontamination.contamination_digest(spans)


def op3_quality_rules(spark, d):
    return quality_rules.judge(table(spark, d, "documents")).drop("broken_rules")


def op4_sharding(spark, d):
    return sharding.place_by_bytes(table(spark, d, "documents"))


def op5_rule_ensemble(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    learn = labels.where(fold("doc_id", 5) != 0)
    model = rule_ensemble.fit(rule_ensemble.labelled_statistics(docs, learn))
    return rule_ensemble.score_quality(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted"
    )


def op6_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_token_counts(spark, d):
    return token_counts.count_tokens(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_warc_bundles(spark, d):
    index = warc_bundles.archive(table(spark, d, "pages"))
    return warc_bundles.read_records(index, with_payload=False).drop("payload")


def op9_simhash(spark, d):
    found = simhash.near_duplicates(table(spark, d, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_language_id(spark, d):
    docs = table(spark, d, "documents")
    network = language_id.fit_language_id(docs.where(fold("doc_id", 4) != 2))
    found = language_id.identify(docs, network)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_url_filters(spark, d):
    return url_filter.judge_urls(table(spark, d, "pages"))


def op12_vector_codes(spark, d):
    found = vector_codes.compress(table(spark, d, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_filter_audit(spark, d):
    return filter_audit.audit_filters(table(spark, d, "documents"), table(spark, d, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_decontamination,
        op3_quality_rules,
        op4_sharding,
        op5_rule_ensemble,
        op6_packing,
        op7_token_counts,
        op8_warc_bundles,
        op9_simhash,
        op10_language_id,
        op11_url_filters,
        op12_vector_codes,
        op13_filter_audit,
    )
}
