"""The queries of this package: one ``opN_<name>`` per operator, and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from vigil.llm import oracles
from vigil.llm.bpe import encode_decode
from vigil.llm.compress_quality import classify
from vigil.llm.html_text import extract
from vigil.llm.line_dedup import dedup_lines
from vigil.llm.mixing import score
from vigil.llm.nearest import nearest
from vigil.llm.packing import pack
from vigil.llm.prefix_trie import spliced_trie
from vigil.llm.quality import judge
from vigil.llm.simhash import near_duplicates
from vigil.llm.token_counts import token_counts
from vigil.llm.turn_repair import damage, repair_turns
from vigil.llm.warc import archive

#: Where the vocabulary file lies; a parameter of the operators, never copied.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark, sf_dir):
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_quality(spark, sf_dir):
    return judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_bpe(spark, sf_dir):
    return encode_decode(_read(spark, sf_dir, "documents"), BYTE_BPE, with_ids=False)


def op4_token_counts(spark, sf_dir):
    return token_counts(_read(spark, sf_dir, "documents"), BYTE_BPE, limit=512)


def op5_lm_score(spark, sf_dir):
    return score(_read(spark, sf_dir, "documents"))


def op6_neighbours(spark, sf_dir):
    return nearest(_read(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op7_warc(spark, sf_dir):
    return archive(_read(spark, sf_dir, "pages"), least_bytes=1000)


def op8_packing(spark, sf_dir):
    return pack(_read(spark, sf_dir, "documents"), BYTE_BPE, capacity=1024, end_id=2)


def op9_line_dedup(spark, sf_dir):
    return dedup_lines(_read(spark, sf_dir, "documents"), min_words=50).select(
        "_doc.doc_id", "n_lines", "n_removed", "_doc.text"
    )


def op10_html_text(spark, sf_dir):
    return extract(_read(spark, sf_dir, "pages"))


def op11_compress_quality(spark, sf_dir):
    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op12_prefix_trie(spark, sf_dir):
    return spliced_trie(_read(spark, sf_dir, "conversations"), step=5, most=9)


def op13_turn_repair(spark, sf_dir):
    rows = _read(spark, sf_dir, "conversations")
    return repair_turns(damage(rows), rows.select("conv_id"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_simhash": op1_simhash,
        "op2_quality": op2_quality,
        "op3_bpe": op3_bpe,
        "op4_token_counts": op4_token_counts,
        "op5_lm_score": op5_lm_score,
        "op6_neighbours": op6_neighbours,
        "op7_warc": op7_warc,
        "op8_packing": op8_packing,
        "op9_line_dedup": op9_line_dedup,
        "op10_html_text": op10_html_text,
        "op11_compress_quality": op11_compress_quality,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_turn_repair": op13_turn_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality": oracles.quality(), "op9_line_dedup": oracles.line_dedup()}
