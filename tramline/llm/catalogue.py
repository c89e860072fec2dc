"""One query per corpus operator, over its whole table, and the corpus pipeline."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from tramline.llm import byte_bpe, chat_format, collocations, decontaminate, lattice_dedup, line_dedup, quality, ranked_search
from tramline.llm import oracles as sql
from tramline.llm import repetition, simhash, substring_dedup, token_blocks, toxicity
from tramline.llm.common import fold, labelled_sample, table
from tramline.session import work_folder

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"


def token_digests(docs):
    """Documents encoded and decoded again, with digests of both."""
    path, pattern = public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN
    decoded = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path, pattern)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_chat_format(spark, sf_dir):
    probe = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(probe, turns.schema))
    return chat_format.read_back(chat_format.format_examples(turns))


def op2_byte_bpe(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_substring_dedup(spark, sf_dir):
    kept = substring_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


BYTE_BPE = "byte_bpe_50k.json"


def op4_token_blocks(spark, sf_dir):
    folder = work_folder(spark, "token-blocks")
    token_blocks.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(BYTE_BPE), end_id=0)
    read = token_blocks.read(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


TOXIC_FOLDS, TOXIC_HELD_OUT, TOXIC_FROM = 4, 2, 0.3


def toxicity_model(docs, labels):
    """Learnt from the labelled documents outside the held-out fold."""
    learnt = labels.filter(fold("doc_id", TOXIC_FOLDS) != TOXIC_HELD_OUT)
    return toxicity.fit(labelled_sample(docs, learnt, "toxic", toxicity.SAMPLE_ROWS, toxicity.SEED))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold("doc_id", TOXIC_FOLDS) == TOXIC_HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op5_decontaminate(spark, sf_dir):
    found = decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("item").alias("item_id"),
        F.col("shared").cast("long").alias("n_shared"),
        F.col("shingles").cast("long").alias("n_shingles"),
    )


def op6_lattice_dedup(spark, sf_dir):
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


QUALITY_FOLDS, QUALITY_HELD_OUT = 3, 1


def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = table(spark, sf_dir, "labels").filter(fold("doc_id", QUALITY_FOLDS) != QUALITY_HELD_OUT)
    model = quality.fit(labelled_sample(docs, learnt, "quality", quality.SAMPLE_ROWS, quality.SEED))
    return quality.score(docs, model).select(
        "doc_id",
        (fold("doc_id", QUALITY_FOLDS) == QUALITY_HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark, sf_dir):
    gone = line_dedup.removed_places(table(spark, sf_dir, "documents"))
    return gone.select(F.col("id").alias("doc_id"), F.size("places").alias("n_removed"), "places")


def op11_ranked_search(spark, sf_dir):
    found = ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_repetition(spark, sf_dir):
    measured = repetition.measure(table(spark, sf_dir, "documents"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_token_blocks": op4_token_blocks,
    "op5_decontaminate": op5_decontaminate,
    "op6_lattice_dedup": op6_lattice_dedup,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_repetition": op13_repetition,
    "pipeline": corpus_pipeline.run,
}


def oracles():
    known = {
        "op5_decontaminate": sql.LEAKS,
        "op11_ranked_search": sql.SEARCH,
        "op12_collocations": sql.PHRASES,
        "op13_repetition": sql.REPETITION,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: text for name, text in known.items() if text}
