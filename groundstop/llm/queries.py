"""The registered ``opN_*`` queries: each runs its operator with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from groundstop.llm import chat_format, count_rtree, curve_pack, fragment_align, fuse_dedup, pfor_ids, phrase_automata, shard_tree, suffix_merge, term_treap, toxicity, trie_lm, winnow

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op2_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    return winnow.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7, and where a ninth shard would take them."""
    eight = shard_tree.tree(8)
    return shard_tree.shard_documents(_table(spark, sf_dir, "documents"), eight, shard_tree.grown(eight))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings only, formatted, stored and read back."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    return chat_format.format_and_check(turns.union(own))


def op5_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the bytes that earlier documents hold."""
    return suffix_merge.repeats(_table(spark, sf_dir, "documents"))


def op6_fuse_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates: half of the documents (by a hash of doc_id) are the snapshot, half the incoming batch."""
    return fuse_dedup.dedup(_table(spark, sf_dir, "documents"))


def op7_curve_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids in sequences of 2048 along the curve, one row per piece."""
    return curve_pack.pack(_table(spark, sf_dir, "documents"), BYTE_BPE, end_id=1)


def op8_trie_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents, learned from nine tenths of them."""
    return trie_lm.score(_table(spark, sf_dir, "documents"))


def op9_pfor_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files: doc_id, start, n_tokens, ids_crc32 as read back from the files."""
    return pfor_ids.write_and_check(_table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)


def op10_count_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of 0.75 or more."""
    return count_rtree.jaccard_components(_table(spark, sf_dir, "documents"))


def op11_term_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of all for every benchmark item."""
    return term_treap.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 20-word windows that start earlier."""
    return phrase_automata.repeats(_table(spark, sf_dir, "documents"))


def op13_fragment_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents in two vocabularies, grouped where both end at the same byte."""
    return fragment_align.align(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_winnow": op2_winnow,
    "op3_shard_tree": op3_shard_tree,
    "op4_chat_format": op4_chat_format,
    "op5_suffix_merge": op5_suffix_merge,
    "op6_fuse_dedup": op6_fuse_dedup,
    "op7_curve_pack": op7_curve_pack,
    "op8_trie_lm": op8_trie_lm,
    "op9_pfor_ids": op9_pfor_ids,
    "op10_count_rtree": op10_count_rtree,
    "op11_term_treap": op11_term_treap,
    "op12_phrase_automata": op12_phrase_automata,
    "op13_fragment_align": op13_fragment_align,
}
ORACLES: dict[str, str] = {
    "op2_winnow": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        win AS (SELECT DISTINCT item_id, ws[i:i + 9] AS g FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
        lens AS (SELECT DISTINCT len(g) AS k FROM win),
        pos AS (SELECT doc_id, k, i, ws[i:i + k - 1] AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, lens WHERE len(ws) >= k)),
        hit AS (SELECT DISTINCT doc_id, i, k, item_id FROM pos JOIN win USING (g)),
        n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
        it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op4_chat_format": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e AS (SELECT *, (length(role || chr(1) || text) - length(replace(role || chr(1) || text, chr(92), ''))
              + (length(role || chr(1) || text) - length(replace(role || chr(1) || text, '<s>', ''))) // 3
              + (length(role || chr(1) || text) - length(replace(role || chr(1) || text, '</s>', ''))) // 4
              + (length(role || chr(1) || text) - length(replace(role || chr(1) || text, '[INST]', ''))) // 6
              + (length(role || chr(1) || text) - length(replace(role || chr(1) || text, '[/INST]', ''))) // 7) AS escapes FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(role) + length(text) + escapes + 23)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op6_fuse_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents),
        g AS (SELECT k, count(*) AS group_size, arg_min(doc_id, (-length(t), doc_id)) AS keep_id FROM d GROUP BY k)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256 FROM d JOIN g USING (k)""",
    "op11_term_treap": r"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        d AS (SELECT r, doc_id, ts, len(ts)::BIGINT AS n FROM t WHERE len(ts) > 0),
        c AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM d),
        q AS (SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
              FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
        p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
        w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term), c),
        s AS (SELECT i, item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l)))))::BIGINT AS score
              FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (r), c GROUP BY i, item_id, r)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM s JOIN d USING (r) WHERE score > 0)
        WHERE rank <= 50""",
}
