"""The operators' registered queries: each over the whole of its table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    ann,
    bag_search,
    bpe,
    conversations,
    exact_dedup,
    language_id,
    minhash,
    packing,
    pii,
    quality,
    rlz_dedup,
    simhash,
    sql,
    suffix_dedup,
)

#: The vocabulary that contracts name; every machine has it at the same place.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


def op1_bm25_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"), WORD_BPE)


def language_model(spark: SparkSession, d: str) -> language_id.Model | None:
    """The field learned from the documents that are not held out."""
    return language_id.train(_table(spark, d, "documents"), remainder(5) != 0)


def op2_crf_language(spark, d):
    docs = _table(spark, d, "documents")
    found = language_id.predict(docs, language_model(spark, d))
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score", "n_words", "runs")


def op3_suffix_arrays(spark, d):
    return suffix_dedup.remove_repeats(_table(spark, d, "documents"), window=400)


def op4_simhash_trie(spark, d):
    return simhash.near_duplicates(_table(spark, d, "documents"), width=3, budget=2)


def op5_fm_quality(spark, d):
    docs, labels = _table(spark, d, "documents"), _table(spark, d, "labels")
    scored = quality.score(docs, quality.train(docs, labels, remainder(4) != 2))
    return scored.select(
        "doc_id",
        (remainder(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_chunk_recipes(spark, d):
    return exact_dedup.exact_groups(_table(spark, d, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op7_relative_lz(spark, d):
    return rlz_dedup.remove_repeats(_table(spark, d, "documents"), window=50)


def op8_forced_boundaries(spark, d):
    return bpe.digests(_table(spark, d, "documents"), WORD_BPE)


def op9_inverted_multi_index(spark, d):
    return ann.search(_table(spark, d, "embeddings"), k=10, every=100)


def op10_anchor_pii(spark, d):
    return pii.digest(_table(spark, d, "documents"))


def op11_parallel_viterbi(spark, d):
    return conversations.audit(conversations.damage(_table(spark, d, "conversations")))


def op12_bag_search(spark, d):
    return bag_search.search(_table(spark, d, "documents"), _table(spark, d, "benchmark"), k=20)


def op13_minhash_lists(spark, d):
    return minhash.near_duplicates(_table(spark, d, "documents"), width=5, percent=85)


QUERIES = {
    q.__name__: q
    for q in (
        op1_bm25_packing,
        op2_crf_language,
        op3_suffix_arrays,
        op4_simhash_trie,
        op5_fm_quality,
        op6_chunk_recipes,
        op7_relative_lz,
        op8_forced_boundaries,
        op9_inverted_multi_index,
        op10_anchor_pii,
        op11_parallel_viterbi,
        op12_bag_search,
        op13_minhash_lists,
    )
}

#: SQL with the same results, where SQL can express them.
ORACLE = {
    "op3_suffix_arrays": sql.SUFFIX_ARRAYS,
    "op4_simhash_trie": sql.SIMHASH,
    "op6_chunk_recipes": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY x) AS keep_id,
               count(*) OVER (PARTITION BY x) AS group_size,
               row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(x) AS text_sha256
        FROM t""",
    "op7_relative_lz": r"""
        WITH cut AS (
          SELECT row_number() OVER () AS row_no, doc_id,
                 [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words
          FROM documents),
        starts AS (
          SELECT row_no, doc_id, unnest(range(1, len(words) - 48)) AS pos, words FROM cut WHERE len(words) >= 50),
        windows AS (
          SELECT row_no, doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS passage FROM starts),
        firsts AS (SELECT passage, min(doc_id) AS least FROM windows GROUP BY passage),
        repeated AS (
          SELECT row_no, pos FROM windows JOIN firsts USING (passage) WHERE least < doc_id),
        numbered AS (
          SELECT row_no, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM cut),
        marked AS (
          SELECT n.row_no, n.pos, n.word,
                 max(r.pos) OVER (PARTITION BY n.row_no ORDER BY n.pos) AS last_start
          FROM numbered n LEFT JOIN repeated r USING (row_no, pos)),
        kept AS (
          SELECT row_no, count(*) AS n_words,
                 count(*) FILTER (pos - last_start < 50) AS n_removed,
                 coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (last_start IS NULL OR pos - last_start >= 50), '') AS left_over
          FROM marked GROUP BY row_no)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(left_over, '')) AS kept_sha256
        FROM cut LEFT JOIN kept USING (row_no)""",
    "op11_parallel_viterbi": """
        WITH RECURSIVE table_of AS (
          SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
        conv AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
        named AS (
          SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 encode(coalesce(conv.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS name
          FROM conversations r JOIN conv ON r.conv_id IS NOT DISTINCT FROM conv.conv_id),
        kinds AS (
          SELECT c, turn, role, text, xor(4294967295, list_reduce(
                   list_concat([4294967295], list_transform(range(octet_length(name)),
                                 lambda i: ('0x' || substr(hex(name), 2 * i + 1, 2))::BIGINT)),
                   lambda h, b: xor(t[(xor(h, b) & 255) + 1], h >> 8))) % 20 AS kind
          FROM named, table_of),
        damaged AS (
          SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
          FROM kinds),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text[:64], md5(text)) AS i,
                 right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tail
          FROM damaged),
        marked AS (
          SELECT *, left(role, 1) AS initial,
                 CASE WHEN tail = '' THEN 1
                      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2
                      WHEN tail NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                 lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
          FROM placed),
        steps AS (
          SELECT c, i, role, text, initial, CASE fault WHEN 3 THEN 3 ELSE 0 END AS extra, fault IN (1, 2) AS must_go FROM marked),
        counted AS (
          SELECT conv_id, conv.c, count(i) AS n,
                 coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                 count(*) FILTER (fault = 3) AS truncated,
                 count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
          FROM conv LEFT JOIN marked ON marked.c = conv.c GROUP BY ALL),
        -- costs to go behind row i, by state: start, after the system row, after a user row, after an answer
        togo(c, i, b0, b1, b2, b3) AS (
          SELECT c, n, 0, 6, 3, 0 FROM counted
          UNION ALL
          SELECT c, i, least(w0, 3 + least(w2, 3 + w3)), least(w1, 3 + least(w2, 3 + w3)), least(w2, 3 + w3), least(w3, 3 + w2)
          FROM (SELECT t.c, t.i - 1 AS i,
                       least(4 + b0, CASE WHEN must_go THEN 1e9::BIGINT ELSE extra + least(
                         3 + b2, CASE initial WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 1e9::BIGINT END) END) AS w0,
                       least(4 + b1, CASE WHEN must_go THEN 1e9::BIGINT ELSE extra + least(
                         3 + b2, CASE initial WHEN 'u' THEN b2 ELSE 1e9::BIGINT END) END) AS w1,
                       least(4 + b2, CASE WHEN must_go THEN 1e9::BIGINT ELSE extra + least(
                         3 + b3, CASE initial WHEN 'a' THEN b3 ELSE 1e9::BIGINT END) END) AS w2,
                       least(4 + b3, CASE WHEN must_go THEN 1e9::BIGINT ELSE extra + least(
                         3 + b2, CASE initial WHEN 'u' THEN b2 ELSE 1e9::BIGINT END) END) AS w3
                FROM togo t JOIN steps s ON s.c = t.c AND s.i = t.i)),
        vectors AS (SELECT c, i, [b0, b1, b2, b3] AS b FROM togo),
        walk(c, n, i, state, audit, lines) AS (
          SELECT c, n, 0, 0, '', []::VARCHAR[] FROM counted
          UNION ALL
          SELECT c, n, CASE letter WHEN 'I' THEN i ELSE i + 1 END,
                 CASE letter WHEN 'D' THEN state WHEN 'K' THEN position(initial IN 'sua') ELSE need END,
                 audit || letter,
                 CASE letter WHEN 'D' THEN lines
                             WHEN 'K' THEN list_append(lines, role || ':' || text)
                             ELSE list_append(lines, CASE need WHEN 3 THEN 'assistant:' ELSE 'user:' END ||
                                                     CASE letter WHEN 'R' THEN text ELSE '' END) END
          FROM (SELECT w.*, s.role, s.text, s.initial, CASE state WHEN 2 THEN 3 ELSE 2 END AS need,
                       CASE WHEN s.i IS NOT NULL AND v.b[state + 1] = 4 + o.b[state + 1] THEN 'D'
                            WHEN v.b[state + 1] = 3 + v.b[CASE state WHEN 2 THEN 4 ELSE 3 END] THEN 'I'
                            WHEN state || s.initial IN ('0s', '0u', '1u', '2a', '3u') AND
                                 v.b[state + 1] = s.extra + o.b[position(s.initial IN 'sua') + 1] THEN 'K'
                            ELSE 'R' END AS letter
                FROM walk w JOIN vectors v ON v.c = w.c AND v.i = w.i
                     LEFT JOIN steps s ON s.c = w.c AND s.i = w.i + 1
                     LEFT JOIN vectors o ON o.c = w.c AND o.i = w.i + 1
                WHERE w.i < w.n OR w.state IN (1, 2)))
        SELECT conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, b[1]::BIGINT AS cost, audit,
               sha256(array_to_string(lines, chr(10))) AS repaired_sha256
        FROM counted JOIN vectors USING (c) JOIN walk USING (c)
        WHERE vectors.i = 0 AND walk.i = walk.n AND walk.state IN (0, 3)""",
    "op12_bag_search": r"""
        WITH cut AS (
          SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
          FROM documents),
        asked AS (
          SELECT item_no, item_id, term, count(*) AS times
          FROM (SELECT item_id, row_number() OVER () AS item_no, unnest(regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
          GROUP BY ALL),
        counted AS (
          SELECT row_no, term, count(*) AS tf
          FROM (SELECT row_no, unnest(terms) AS term FROM cut) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        whole AS (SELECT count(*) AS n_all, sum(len(terms))::BIGINT AS l_all FROM cut WHERE len(terms) > 0),
        weighed AS (
          SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
          FROM counted, whole GROUP BY term, n_all),
        lengths AS (SELECT row_no, doc_id, 100 - 25 + (25 * len(terms) * n_all) // l_all AS m FROM cut, whole),
        scored AS (
          SELECT item_no, item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
          FROM asked JOIN counted USING (term) JOIN weighed USING (term) JOIN lengths USING (row_no)
          GROUP BY item_no, item_id, row_no, doc_id),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS rank
          FROM scored WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
    "op13_minhash_lists": sql.MINHASH,
}
