"""The operators applied to their whole tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import ann, bpe, decontaminate, language, licenses, packing, prefix_tree, quotes, secrets, simhash, tokenfile, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents", ["doc_id", "text"])


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file; every executor has the files there."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_groups(documents(spark, folder))


@query
def op2_bpe_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    return bpe.digests(documents(spark, folder), tokenizer_path("word_bpe_49k.json"))


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases, labels and coverage of every document."""
    return licenses.license_spans(documents(spark, folder)).drop("spans")


@query
def op5_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids written as segments and read back."""
    path = tokenfile.token_file(documents(spark, folder), tokenizer_path("byte_bpe_50k.json"))
    return tokenfile.document_digests(spark, path)


def _remainder(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from three of four folds.

    ``held_out`` of a null id is false, and such a row is learned nothing from.
    """
    docs = documents(spark, folder)
    labels = table(spark, folder, "labels", ["doc_id", "toxic"])
    model = toxicity.train(docs, labels, may_learn=_remainder(4) != 2)
    return toxicity.toxicity(docs, model).select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from two of three folds.

    ``held_out`` of a null id is false, and such a row is learned nothing from.
    """
    docs = table(spark, folder, "documents", ["doc_id", "text", "lang"])
    model = language.train(docs.where(_remainder(3) != 1))
    return language.languages(docs, model).select(
        "doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query
def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest embeddings of every 50th, searched among all."""
    vectors = table(spark, folder, "embeddings", ["vec_id", "embedding"])
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents, with the score and place of the passage."""
    return decontaminate.contaminated(documents(spark, folder), table(spark, folder, "benchmark", ["item_id", "text"]))


@query
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates and secrets of every document."""
    docs = documents(spark, folder)
    return secrets.findings(docs, secrets.train(docs))


@query
def op3_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """Every message of every conversation without quotes, in reply order."""
    return quotes.conversations(table(spark, folder, "conversations", ["conv_id", "turn", "role", "text"]))


@query
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on the eight components of largest variance, scaled to one."""
    return whitening.whitened(table(spark, folder, "embeddings", ["vec_id", "embedding"]))


@query
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return packing.piece_digests(documents(spark, folder), tokenizer_path("byte_bpe_50k.json"))


@query
def op13_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with the totals of its subtree."""
    return prefix_tree.conversation_tree(table(spark, folder, "conversations", ["conv_id", "turn", "role", "text"]))


#: CRC-32 of a conversation's decimal digits is worked out bit by bit; beginnings are told apart by
#: the digests of their turns, written one after another; totals are sums over all deeper beginnings.
CHECKS["op13_conversation_prefix_trie"] = r"""
WITH m AS (
    SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT conv, md5(concat(length(role), ':', role, ':', text)) AS content,
           len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
           row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(concat(length(role), ':', role, ':', text))) AS place
    FROM m
), convs AS (
    SELECT conv, conv - conv % 20 AS base, max(place) AS own,
           xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda s, c: list_reduce(list_prepend(xor(s, c), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
                                     lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h
    FROM placed GROUP BY conv
), sized AS (
    SELECT c.conv, c.base, c.h, least(c.h, coalesce(b.own, 0)) AS lent, greatest(c.own - c.h, 0) AS rest
    FROM convs c LEFT JOIN convs b ON b.conv = c.base
), turns AS (
    SELECT s.conv, p.place AS depth, p.content, p.words FROM sized s JOIN placed p ON p.conv = s.base AND p.place <= s.h
    UNION ALL
    SELECT s.conv, p.place - s.h + s.lent, p.content, p.words FROM sized s JOIN placed p ON p.conv = s.conv AND p.place > s.h
), begun AS (
    SELECT conv, 0 AS depth, '' AS path, 0 AS words FROM convs
    UNION ALL
    SELECT conv, depth, string_agg(content, '') OVER (PARTITION BY conv ORDER BY depth), words FROM turns
), nodes AS (
    SELECT depth, path, min(conv) AS conv_id, count(*) AS n_convs, max(words) AS words FROM begun GROUP BY depth, path
), named AS (
    SELECT b.conv, n.depth, n.conv_id, n.n_convs, n.words, n.path FROM begun b JOIN nodes n ON b.depth = n.depth AND b.path = n.path
), own AS (
    SELECT n.conv_id, n.depth, n.n_convs, n.words, p.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN named p ON p.conv = n.conv_id AND p.depth = n.depth - 1
), children AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM own WHERE depth > 0 GROUP BY 1, 2
), full_own AS (
    SELECT o.*, coalesce(c.n_children, 0) AS n_children FROM own o LEFT JOIN children c ON o.conv_id = c.conv_id AND o.depth = c.depth
), totals AS (
    SELECT a.conv_id, a.depth, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
    FROM full_own f JOIN named a ON a.conv = f.conv_id AND a.depth <= f.depth
    GROUP BY a.conv_id, a.depth
), ends AS (
    SELECT a.conv_id, a.depth, sha256(string_agg(CAST(s.conv AS VARCHAR), ',' ORDER BY s.conv)) AS ends_sha256
    FROM sized s JOIN named a ON a.conv = s.conv AND a.depth = s.lent + s.rest
    GROUP BY a.conv_id, a.depth
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent_conv_id, f.n_convs, f.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
       CAST(t.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM full_own f JOIN totals t ON f.conv_id = t.conv_id AND f.depth = t.depth
LEFT JOIN ends e ON f.conv_id = e.conv_id AND f.depth = e.depth
"""


CHECKS["op3_quotation_links"] = r"""
WITH RECURSIVE m AS (
    SELECT row_number() OVER () AS rid, conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), q AS (
    SELECT *, regexp_matches(text, '(^|\n)[ \t]*>') AS quotes FROM m
), lines AS (
    SELECT rid, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM q WHERE quotes
), cut AS (
    SELECT rid, conv_id, turn, place, line, regexp_extract(line, '^[ \t>]*') AS lead FROM lines
), leveled AS (
    SELECT rid, conv_id, turn, place, length(lead) - length(replace(lead, '>', '')) AS level,
           substr(line, length(lead) + 1) AS body, line
    FROM cut
), runs AS (
    SELECT *, place - row_number() OVER (PARTITION BY rid, level ORDER BY place) AS run FROM leveled WHERE level > 0
), passages AS (
    SELECT conv_id, turn, level, string_agg(body, ' ' ORDER BY place) AS body, 1 AS whole
    FROM runs GROUP BY rid, conv_id, turn, level, run
    UNION ALL SELECT conv_id, turn, level, body, 0 FROM runs
), quoted AS (
    SELECT conv_id, turn, level, whole, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) AS unit FROM passages
), kept AS (
    SELECT rid, string_agg(line, chr(10) ORDER BY place) AS text FROM leveled WHERE level = 0 GROUP BY rid
), own AS (
    SELECT q.conv_id, q.turn, q.role,
           trim(CASE WHEN quotes THEN coalesce(kept.text, '') ELSE q.text END, ' ' || chr(9) || chr(10) || chr(13) || chr(12)) AS text
    FROM q LEFT JOIN kept USING (rid)
), units AS (
    SELECT conv_id, turn, trim(regexp_replace(lower(unnest(list_concat([text], regexp_split_to_array(text, '\n[ \t]*\n'),
           string_split(text, chr(10))))), '\s+', ' ', 'g')) AS unit
    FROM own
), firsts AS (
    SELECT conv_id, unit, min(turn) AS first FROM units WHERE unit <> '' GROUP BY conv_id, unit
), links AS (
    SELECT conv_id, turn, first AS reply_to FROM (
        SELECT q.conv_id, q.turn, f.first,
               row_number() OVER (PARTITION BY q.conv_id, q.turn ORDER BY level, whole DESC, f.first DESC) AS best
        FROM quoted q JOIN firsts f ON q.conv_id = f.conv_id AND q.unit = f.unit AND f.first < q.turn)
    WHERE best = 1
), walk AS (
    SELECT conv_id, turn, reply_to AS thread FROM links
    UNION ALL SELECT w.conv_id, w.turn, l.reply_to FROM walk w JOIN links l ON l.conv_id = w.conv_id AND l.turn = w.thread
), threads AS (
    SELECT conv_id, turn, min(thread) AS thread FROM walk GROUP BY conv_id, turn
)
SELECT o.conv_id, o.turn, o.role, l.reply_to, coalesce(t.thread, o.turn) AS thread,
       row_number() OVER (PARTITION BY o.conv_id ORDER BY coalesce(t.thread, o.turn) NULLS FIRST, o.turn NULLS FIRST,
                          o.role NULLS FIRST, md5(o.text)) - 1 AS position, o.text
FROM own o LEFT JOIN links l ON o.conv_id = l.conv_id AND o.turn = l.turn
LEFT JOIN threads t ON o.conv_id = t.conv_id AND o.turn = t.turn
"""
