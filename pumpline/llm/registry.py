"""The operators as registered queries, with their SQL where SQL can express them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.llm import align, bpe, chat, fertility, langid, lexical, lm, mixing, quality, setjoin, simhash, topk, toxicity
from pumpline.llm.common import is_fold, read_table

ENCODING_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY, BYTE_VOCABULARY = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
ALIGNED_VOCABULARY = "byte_bpe_50k.json"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held = is_fold(F.col("doc_id"), 4, 2)
    model = quality.fit_quality(docs, labels.where(~held))
    scored = quality.score_quality(docs.select("doc_id", "text"), model, out="score")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = is_fold(F.col("doc_id"), 4, 2)
    model = langid.fit_language_model(docs.where(~held))
    judged = langid.predict_language(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score", "language.bits_per_byte")


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = is_fold(F.col("doc_id"), 7, 2)
    model, counts = lm.fit_language_model(docs.where(~held))
    return lm.score_texts(docs, model, counts, {"doc_id": F.col("doc_id"), "held_out": held})


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return fertility.judge(docs, public_tokenizers.path(PIECE_VOCABULARY), public_tokenizers.path(BYTE_VOCABULARY))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode_documents(docs, public_tokenizers.path(ENCODING_VOCABULARY), with_ids=False)
    return done.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held = is_fold(F.col("doc_id"), 5, 0)
    model = toxicity.fit_toxicity(docs, labels.where(~held))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model, out="score")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = chat.rotate(read_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return turned.select("conv_id", "assistant", "part", "first_turn", "n_turns", "begins_at", "rendered", mask.alias("mask"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_components(read_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return align.align_tokenizers(docs, public_tokenizers.path(ALIGNED_VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_language": op2_language,
    "op3_lm": op3_lm,
    "op4_simhash": op4_simhash,
    "op5_fertility": op5_fertility,
    "op6_bpe": op6_bpe,
    "op7_topk": op7_topk,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_chat": op10_chat,
    "op11_ngram_join": op11_ngram_join,
    "op12_alignment": op12_alignment,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": pipeline,
}

ORACLE_SQL = {
    "op8_mixing": mixing.OP8_SQL,
    "op10_chat": chat.OP10_SQL,
    "op11_ngram_join": setjoin.OP11_SQL,
    "op13_lexical_search": lexical.OP13_SQL,
}
