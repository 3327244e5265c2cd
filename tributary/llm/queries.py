"""Registered queries of the operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tributary.llm import bpe, chat, compression, grammar, html, jaccard, mixing, outliers, substrings, toxicity, trie, urls, vectors
from tributary.llm.common import held_out
from tributary.llm.oracles import CHAT_SQL, JACCARD_SQL, MIXING_SQL, REPAIR_SQL, SUBSTRINGS_SQL, TRIE_SQL, URLS_SQL, VECTORS_SQL
from tributary.plans.registry import Query
from tributary.tables import Tables

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: verdict, host, path
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

LLM_QUERIES: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    def register(build):
        LLM_QUERIES[key] = Query(key, build, oracle)
        return build

    return register


@query("op1_mixing", MIXING_SQL)
def op1_mixing(t: Tables):
    return mixing.mixed_sizes(mixing.mix(t.documents))


@query("op2_toxicity")
def op2_toxicity(t: Tables):
    model = toxicity.train(t.documents, t.labels, skip=held_out("doc_id", 4, 2))
    scored = toxicity.score(t.documents, model)
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted", "span_starts", "span_ends")


@query("op3_substrings", SUBSTRINGS_SQL)
def op3_substrings(t: Tables):
    return substrings.summary(t.documents)


@query("op4_outliers")
def op4_outliers(t: Tables):
    return outliers.judge(t.documents)


@query("op5_jaccard", JACCARD_SQL)
def op5_jaccard(t: Tables):
    return jaccard.linked_documents(jaccard.join(t.documents))


@query("op6_bpe")
def op6_bpe(t: Tables):
    return bpe.encode(t.documents, VOCABULARY)


@query("op7_compression")
def op7_compression(t: Tables):
    model = compression.train(t.documents, t.labels, skip=held_out("doc_id", 5, 0))
    scored = compression.score(t.documents, model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("score"), "predicted")


@query("op8_urls", URLS_SQL)
def op8_urls(t: Tables):
    return urls.judge(t.pages, urls.rules_frame(t.spark, URL_RULES))


@query("op9_vectors", VECTORS_SQL)
def op9_vectors(t: Tables):
    return vectors.near_copies(t.embeddings)


@query("op10_chat", CHAT_SQL)
def op10_chat(t: Tables):
    return chat.collapse(t.conversations).withColumnRenamed("conv", "conv_id")


@query("op11_trie", TRIE_SQL)
def op11_trie(t: Tables):
    return trie.nodes(t.conversations)


@query("op12_repair", REPAIR_SQL)
def op12_repair(t: Tables):
    return grammar.repaired(t.conversations)


@query("op13_html")
def op13_html(t: Tables):
    return html.extract(t.pages)
