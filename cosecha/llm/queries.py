"""The registered queries of this subpackage."""

from __future__ import annotations

from cosecha.llm import chat, decontam, mixing, negatives, structure
from cosecha.llm.common import prepare, table


def op1_packing(spark, sf_dir):
    from cosecha.llm.packing import pack_documents
    prepare(spark)
    return pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op2_chat(spark, sf_dir):
    from cosecha.llm.chat import SCHEMAS, link_tools, turns_as_calls
    prepare(spark)
    calls, results = turns_as_calls(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    return link_tools(calls, results, schemas)


def op3_simhash(spark, sf_dir):
    from cosecha.llm.simhash import near_duplicates
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_ann(spark, sf_dir):
    from pyspark.sql import functions as F

    from cosecha.llm.ann import nearest
    prepare(spark)
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_decontaminate(spark, sf_dir):
    from cosecha.llm.decontam import decontaminate, digest
    prepare(spark)
    return digest(decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_repeats(spark, sf_dir):
    from cosecha.llm.repeats import repeated_bytes
    prepare(spark)
    return repeated_bytes(table(spark, sf_dir, "documents"))


def op7_token_counts(spark, sf_dir):
    from cosecha.llm.unigram import count_tokens
    prepare(spark)
    return count_tokens(table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    from cosecha.llm.toxicity import fit
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs.select("doc_id", "text")).select("doc_id", "held_out", "score", "predicted")


def op9_sharding(spark, sf_dir):
    from cosecha.llm.sharding import shard_documents
    prepare(spark)
    return shard_documents(table(spark, sf_dir, "documents"))


def op10_repair(spark, sf_dir):
    from cosecha.llm.repair import repair_round_trip
    prepare(spark)
    return repair_round_trip(table(spark, sf_dir, "documents"))


def op11_structure(spark, sf_dir):
    from cosecha.llm.structure import repair_conversations
    prepare(spark)
    return repair_conversations(table(spark, sf_dir, "conversations"))


def op12_mixing(spark, sf_dir):
    from cosecha.llm.mixing import mix_documents
    prepare(spark)
    return mix_documents(table(spark, sf_dir, "documents"))


def op13_negatives(spark, sf_dir):
    from cosecha.llm.negatives import mine_embeddings
    prepare(spark)
    return mine_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_chat": op2_chat,
    "op3_simhash": op3_simhash,
    "op4_ann": op4_ann,
    "op5_decontaminate": op5_decontaminate,
    "op6_repeats": op6_repeats,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_repair": op10_repair,
    "op11_structure": op11_structure,
    "op12_mixing": op12_mixing,
    "op13_negatives": op13_negatives,
}

#: DuckDB statements of the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op2_chat": chat.ORACLE,
    "op5_decontaminate": decontam.ORACLE,
    "op11_structure": structure.ORACLE,
    "op12_mixing": mixing.ORACLE,
    "op13_negatives": negatives.ORACLE,
}
