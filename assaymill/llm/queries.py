"""One query per operator over its whole table, with production parameters; digests as contracted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_ngram_join as op1
from . import op2_line_dedup as op2
from . import op3_html_text as op3
from . import op4_line_frequency as op4
from . import op5_topk as op5
from . import op6_mixing as op6
from . import op7_toxicity as op7
from . import op8_superkmers as op8
from . import op9_packing as op9
from . import op10_secrets as op10
from . import op11_byte_bpe as op11
from . import op12_whitening as op12
from . import op13_conversation_repair as op13
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_line_dedup(spark, folder):
    """Texts travel as digests: the operator itself returns them whole."""
    out = op2.dedup_lines(table(spark, folder, "documents"))
    return out.select("row.doc_id", "n_lines", "n_removed", F.length("text").cast("bigint").alias("n_chars"),
                      F.sha2("text", 256).alias("text_sha256"))


@query
def op3_html_text(spark, folder):
    return op3.extract_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op4_line_frequency(spark, folder):
    return op4.line_frequency_rules(table(spark, folder, "documents"))


def tokenizer_path() -> str:
    """The shipped vocabulary file; any other file of the library is a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op9_packing(spark, folder):
    return op9.tokenize_and_pack(table(spark, folder, "documents"), tokenizer_path(), 4096)


@query
def op10_secrets(spark, folder):
    out = op10.find_secrets(table(spark, folder, "documents"))
    order = F.create_map(*[x for i, k in enumerate(op10.KINDS) for x in (F.lit(k), F.lit(i))])
    live = F.transform("live", lambda s: F.struct(F.lit("live").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    every = F.transform(
        F.array_sort(F.transform(F.concat("base", live), lambda s: F.struct(
            s["start"].alias("start"), order[s["kind"]].alias("place"),
            s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def n(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return out.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(op10.joined(F.col("base")), 256).alias("base_sha256"),
                      op10.joined(every).alias("spans"))


@query
def op8_superkmers(spark, folder):
    return op8.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op1_ngram_join(spark, folder):
    return op1.ngram_components(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op5_topk(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return op5.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


#: The documents name no domain; a source's number stands for one. Without a number that fits: 'other'.
DOMAIN = ("CASE TRY_CAST(regexp_extract(source, '[0-9]+$', 0) AS INT) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' "
          "WHEN 2 THEN 'forum' ELSE 'other' END")
WEIGHTS = {"domain": {"web": 5, "books": 3, "forum": 2}, "language": {"en": 6, "de": 2, "fr": 1, "es": 1}, "source": {}}


@query
def op6_mixing(spark, folder):
    """Four fifths of the corpus' tokens, so that some branches run short and others pass over."""
    mixed = op6.mix(table(spark, folder, "documents"), op6.share_of_corpus(80), F.expr(DOMAIN), WEIGHTS, max_epochs=2)
    return mixed.select("row.doc_id", "domain", "language", "source", "tokens", "epoch")


@query
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    classifier = op7.train(docs, table(spark, folder, "labels"), ~op7.held_out(F.col("doc_id")))
    return op7.score(docs, classifier).select(
        "row.doc_id", op7.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op11_byte_bpe(spark, folder):
    """Ids and decoded bytes travel as digests: the operator itself returns them whole."""
    import public_tokenizers

    codec = op11.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = op11.decode(op11.encode(table(spark, folder, "documents"), codec, keep=["doc_id"]), codec)
    return out.select("row.doc_id", op11.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op12_whitening(spark, folder):
    return op12.whiten(table(spark, folder, "embeddings"))


@query
def op13_conversation_repair(spark, folder):
    return op13.repair(op13.damage(table(spark, folder, "conversations")), lost_col="lost")
