"""Registered queries of this package: ``opN_<name>(spark, sf_dir)`` and ``pipeline``."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink.llm import op4_url_lists as lists
from recordlink.llm import op5_warc as warc
from recordlink.llm import op9_binary as binary
from recordlink.llm.common import documents
from recordlink.llm.op1_vptree import nearest
from recordlink.llm.op2_packing import pack
from recordlink.llm.op3_quality import quality_report
from recordlink.llm.op6_secrets import secret_report
from recordlink.llm.op7_sampling import sample_encodings
from recordlink.llm.op8_jaccard import jaccard_components
from recordlink.llm.op10_sharding import assign_shards
from recordlink.llm import op11_filter_audit as filters
from recordlink.llm.op12_personal_data import personal_report
from recordlink.llm import op13_conversations as conversations


def op1_nearest(spark, sf_dir):
    return nearest(documents(spark, sf_dir, "embeddings"), every=20, k=20, factor=2.0)


def op2_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), length=4096, end_id=2, with_ids=False)


def op3_quality_rules(spark, sf_dir):
    return quality_report(documents(spark, sf_dir))


def op4_url_lists(spark, sf_dir):
    pages = documents(spark, sf_dir, "pages")
    return lists.evaluate(lists.derived_captures(pages), lists.derived_entries(pages))


def op5_warc(spark, sf_dir):
    return warc.read_records(warc.write_warc(documents(spark, sf_dir, "pages")))


def op6_secret_scans(spark, sf_dir):
    return secret_report(documents(spark, sf_dir))


def op7_sampled_encoding(spark, sf_dir):
    return sample_encodings(documents(spark, sf_dir), k=2, with_ids=False)


def op8_jaccard_join(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir), k=3, percent=90)


def op9_binary_output(spark, sf_dir):
    return binary.read_records(binary.write_records(documents(spark, sf_dir), end_id=0), with_ids=False)


def op10_sharding(spark, sf_dir):
    return assign_shards(documents(spark, sf_dir), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_filter_audit(spark, sf_dir):
    return filters.filter_audit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op12_personal_data(spark, sf_dir):
    return personal_report(documents(spark, sf_dir))


def op13_conversation_repair(spark, sf_dir):
    rows = documents(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damage(rows), rows)


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_nearest, op2_packing, op3_quality_rules, op4_url_lists, op5_warc, op6_secret_scans,
                                   op7_sampled_encoding, op8_jaccard_join, op9_binary_output, op10_sharding, op11_filter_audit, op12_personal_data,
                                   op13_conversation_repair, pipeline)}
ORACLE: dict[str, str] = {"op4_url_lists": lists.SQL, "op11_filter_audit": filters.SQL}
