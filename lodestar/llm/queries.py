"""The registered queries of this subpackage: thin uses of the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lodestar.llm.alignment import align_report
from lodestar.llm.bpe import encode_report
from lodestar.llm.chat_format import chat_digest, format_chats
from lodestar.llm.common import fold, table
from lodestar.llm.exact_dedup import exact_groups
from lodestar.llm.hmm_lm import score_texts
from lodestar.llm.lang_id import identify, learn
from lodestar.llm.mixing import mix_report
from lodestar.llm.near_dedup import near_groups
from lodestar.llm.quality import quality_scores
from lodestar.llm.secrets import learn as learn_secrets
from lodestar.llm.secrets import secret_report
from lodestar.llm.spelling import spelling_groups
from lodestar.llm.token_files import token_file_report
from lodestar.llm.topk_search import search

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op6_exact_dedup", r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op6_exact_dedup(spark, sf):
    return exact_groups(table(spark, sf, "documents").select("doc_id", "text"))


@register("op2_mixing")
def op2_mixing(spark, sf):
    return mix_report(table(spark, sf, "documents").select("doc_id", "text", "source"))


@register("op10_chat_format", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
n AS (SELECT *, row_number() OVER w - 1 AS pos, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS size,
        23 + length(role) + 1 + length(regexp_replace(text,
          '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS chars
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
a AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY pos) - size AS ahead FROM n),
sys AS (SELECT conv_id, size AS s, chars AS sys_chars FROM n WHERE pos = 0 AND role = 'system'),
t AS (SELECT a.*, coalesce(sys_chars, 0) AS sys_chars, greatest(512 - 128 - coalesce(s, 0), 128) AS stride
      FROM a LEFT JOIN sys USING (conv_id)),
w AS (SELECT *, 2 * (ahead // stride) + CASE WHEN ahead // stride = (ahead + size - 1) // stride THEN 0 ELSE 1 END AS win FROM t),
spans AS (SELECT conv_id, win, min(pos) AS from_pos, min(ahead) AS from_at, max(sys_chars) AS sys_chars
          FROM w GROUP BY conv_id, win HAVING min(pos) > 0),
more AS (SELECT conv_id, sum(chars) AS chars FROM (
           SELECT s.conv_id, t.chars FROM spans s JOIN t ON t.conv_id = s.conv_id AND t.ahead < s.from_at
             AND t.ahead >= s.from_at - 128 AND (t.pos > 0 OR t.role <> 'system')
           UNION ALL SELECT conv_id, sys_chars FROM spans) GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(t.chars) + coalesce(max(more.chars), 0) AS BIGINT) AS formatted_chars
FROM t LEFT JOIN more USING (conv_id) GROUP BY conv_id""")
def op10_chat_format(spark, sf):
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(probe).alias("text"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_digest(format_chats(rows))


@register("op1_bpe")
def op1_bpe(spark, sf):
    return encode_report(table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


@register("op3_token_files")
def op3_token_files(spark, sf):
    return token_file_report(table(spark, sf, "documents").select("doc_id", "text"),
                             public_tokenizers.path(TOKENIZER), end_id=2)


@register("op4_lang_id")
def op4_lang_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    learned = learn(docs.where(fold(F.col("doc_id"), 5) != 0))
    found = identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


@register("op8_quality")
def op8_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scores = quality_scores(docs, table(spark, sf, "labels"), fold(F.col("doc_id"), 5) != 0)
    return scores.select("doc_id", (~F.col("train")).alias("held_out"), "score", "predicted")


@register("op7_hmm_lm")
def op7_hmm_lm(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scores = score_texts(docs, fold(F.col("doc_id"), 7) != 2)
    return scores.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@register("op5_near_dedup")
def op5_near_dedup(spark, sf):
    return near_groups(table(spark, sf, "documents").select("doc_id", "text"))


@register("op9_topk_search", """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
p AS (SELECT q.vec_id, a.vec_id AS neighbor_id,
             CAST(list_sum(list_transform(list_zip(q.bits, a.bits), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END))
                  AS BIGINT) AS distance
      FROM c q, c a WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM p)
SELECT vec_id, rank, neighbor_id, distance FROM r WHERE rank <= 10""")
def op9_topk_search(spark, sf):
    return search(table(spark, sf, "embeddings").select("vec_id", "embedding"), F.col("id") % 20 == 0, k=10)


@register("op12_spelling")
def op12_spelling(spark, sf):
    return spelling_groups(table(spark, sf, "documents").select("doc_id", "text"))


@register("op13_alignment")
def op13_alignment(spark, sf):
    return align_report(table(spark, sf, "documents").select("doc_id", "text"),
                        public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


@register("op11_secrets")
def op11_secrets(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return secret_report(docs, learn_secrets(docs))
