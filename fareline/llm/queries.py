"""The registered queries of the text operators: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

from . import bpe, chat, langid, mixing, periodic, quality, simhash, syncmers, tokencount, toxicity, trie, urls, warc
from .common import read


def op1_simhash(spark, sf_dir):
    return simhash.simhash_report(read(spark, sf_dir, "documents"))


def op2_langid(spark, sf_dir):
    return langid.lang_report(read(spark, sf_dir, "documents"))


def op3_bpe(spark, sf_dir):
    return bpe.bpe_report(read(spark, sf_dir, "documents"))


def op4_warc_revisits(spark, sf_dir):
    return warc.warc_report(read(spark, sf_dir, "pages"))


def op5_mixing(spark, sf_dir):
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op6_syncmers(spark, sf_dir):
    return syncmers.fingerprint_report(read(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_quality_cascade(spark, sf_dir):
    return quality.quality_report(read(spark, sf_dir, "documents"))


def op9_chat_format(spark, sf_dir):
    return chat.chat_report(chat.with_probe(read(spark, sf_dir, "conversations"), spark))


def op10_url_rules(spark, sf_dir):
    return urls.judge_urls(read(spark, sf_dir, "pages"))


def op11_prefix_trie(spark, sf_dir):
    return trie.trie_report(read(spark, sf_dir, "conversations"))


def op12_periodic_runs(spark, sf_dir):
    return periodic.runs_report(read(spark, sf_dir, "documents"))


def op13_token_counts(spark, sf_dir):
    return tokencount.token_report(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash": (op1_simhash, None),
    "op2_langid": (op2_langid, None),
    "op3_bpe": (op3_bpe, None),
    "op4_warc_revisits": (op4_warc_revisits, warc.SQL),
    "op5_mixing": (op5_mixing, None),
    "op6_syncmers": (op6_syncmers, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_quality_cascade": (op8_quality_cascade, quality.SQL),
    "op9_chat_format": (op9_chat_format, chat.SQL),
    "op10_url_rules": (op10_url_rules, urls.SQL),
    "op11_prefix_trie": (op11_prefix_trie, trie.SQL),
    "op12_periodic_runs": (op12_periodic_runs, None),
    "op13_token_counts": (op13_token_counts, None),
}
