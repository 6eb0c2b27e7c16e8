"""SQL for the queries whose results need some more of it: byte strings, XXH64, components of links."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The documents' words, A-Z lower-cased.
_CUT = rf"""cut AS (
          SELECT row_number() OVER () AS row_no, doc_id,
                 [w FOR w IN regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+') IF w <> ''] AS words
          FROM documents)"""
#: For each c of ``classes`` the least document that ``links`` (a, b) reach.
_ROOTS = """edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(c, other) AS (
          SELECT c, c FROM classes
          UNION
          SELECT r.c, edges.b FROM reached r JOIN edges ON edges.a = r.other),
        roots AS (
          SELECT r.c, min(o.least) AS root FROM reached r JOIN classes o ON o.c = r.other GROUP BY r.c)"""

SUFFIX_ARRAYS = """
        WITH t AS (SELECT row_number() OVER () AS row_no, doc_id, encode(coalesce(text, '')) AS x FROM documents),
        starts AS (
          SELECT row_no, x, unnest(range(1, octet_length(x) - 398)) AS pos FROM t WHERE octet_length(x) >= 400),
        windows AS (SELECT row_no, pos, md5(array_slice(x, pos, pos + 399)) AS string FROM starts),
        again AS (SELECT string FROM windows GROUP BY string HAVING count(*) > 1),
        repeated AS (
          SELECT row_no, pos, coalesce(pos - lag(pos) OVER (PARTITION BY row_no ORDER BY pos) > 400, true) AS fresh
          FROM windows JOIN again USING (string)),
        numbered AS (
          SELECT row_no, pos, sum(fresh::INTEGER) OVER (PARTITION BY row_no ORDER BY pos) AS span FROM repeated),
        spans AS (SELECT row_no, min(pos) AS first, max(pos) + 400 AS behind FROM numbered GROUP BY row_no, span),
        pieces AS (
          SELECT row_no, lag(behind, 1, 1) OVER (PARTITION BY row_no ORDER BY first) AS a, first AS b FROM spans
          UNION ALL
          SELECT row_no, coalesce(max(behind), 1), any_value(octet_length(x)) + 1 FROM t LEFT JOIN spans USING (row_no) GROUP BY row_no),
        kept AS (
          SELECT row_no, string_agg(CASE WHEN a < b THEN hex(array_slice(x, a, b - 1)) ELSE '' END, '' ORDER BY a) AS left_over
          FROM pieces JOIN t USING (row_no) GROUP BY row_no),
        removed AS (SELECT row_no, sum(behind - first)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row_no)
        SELECT doc_id, octet_length(x)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(unhex(left_over)) AS kept_sha256
        FROM t JOIN kept USING (row_no) LEFT JOIN removed USING (row_no)"""

_TWO_64 = 18446744073709551616
_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)  # fixed values of XXH64


def _times(x, factor):
    return f"(({x})::UHUGEINT * {factor}::UHUGEINT % {_TWO_64})"


def _turned(x, bits):
    """A rotation to the left, as a product modulo 2 ** 64 - 1."""
    return f"(({x})::UHUGEINT * {1 << bits}::UHUGEINT % {_TWO_64 - 1})"


def _plus(x, y):
    return f"((({x})::UHUGEINT + ({y})::UHUGEINT) % {_TWO_64})"


def _shifted(x, bits):
    return f"list_transform([{x}], lambda z: xor(z, z // {1 << bits}::UHUGEINT))[1]"


def _xxh64_steps(source: str, seed: int) -> str:
    """CTEs up to ``hashed`` (shingle, h): the XXH64 of the texts ``shingle`` in ``source``."""
    p1, p2, p3, p4, p5 = _PRIMES
    stripe = lambda a, k: _times(_turned(_plus(a, _times(k, p2)), 31), p1)
    number = lambda at, n: "('0x' || " + " || ".join(f"substr(x, {at} + {2 * i + 1}, 2)" for i in reversed(range(n))) + ")::UBIGINT::UHUGEINT"
    starts = [(seed + p1 + p2) % _TWO_64, (seed + p2) % _TWO_64, seed, (seed - p1) % _TWO_64]
    columns = ", ".join(
        f"list_reduce(list_concat([{v}::UHUGEINT], [lanes[i] FOR i IN range({j + 1}, n // 32 * 4 + 1, 4)]), lambda a, k: {stripe('a', 'k')}) AS v{j}"
        for j, v in enumerate(starts)
    )
    whole = _plus(_plus(_turned("v0", 1), _turned("v1", 7)), _plus(_turned("v2", 12), _turned("v3", 18)))
    for j in range(4):
        whole = _plus(_times(f"xor({whole}, {stripe('0', f'v{j}')})", p1), p4)
    lane = _plus(_times(_turned(f"xor(a, {stripe('0', 'k')})", 27), p1), p4)
    four = _plus(_times(_turned(f"xor(h, {_times(number('2 * (n // 8 * 8)', 4), p1)})", 23), p2), p3)
    byte = _times(_turned(f"xor(a, {_times('k', p5)})", 11), p1)
    end = _shifted(_times(_shifted(_times(_shifted("h", 33), p2), 29), p3), 32)
    return f"""
        bytes_of AS (SELECT shingle, hex(encode(shingle)) AS x, octet_length(encode(shingle)) AS n FROM (SELECT DISTINCT shingle FROM {source})),
        cut_up AS (
          SELECT *, [{number("16 * i", 8)} FOR i IN range(n // 8)] AS lanes,
                 [('0x' || substr(x, 2 * i + 1, 2))::UBIGINT::UHUGEINT FOR i IN range(n // 4 * 4, n)] AS tail
          FROM bytes_of),
        striped AS (SELECT *, {columns} FROM cut_up),
        begun AS (SELECT *, {_plus(f"CASE WHEN n < 32 THEN {(seed + p5) % _TWO_64}::UHUGEINT ELSE {whole} END", "n")} AS h FROM striped),
        eights AS (
          SELECT * REPLACE (list_reduce(list_concat([h], [lanes[i] FOR i IN range(n // 32 * 4 + 1, n // 8 + 1)]), lambda a, k: {lane}) AS h) FROM begun),
        fours AS (SELECT * REPLACE (CASE WHEN n % 8 >= 4 THEN {four} ELSE h END AS h) FROM eights),
        ends AS (SELECT * REPLACE (list_reduce(list_concat([h], tail), lambda a, k: {byte}) AS h) FROM fours),
        hashed AS (SELECT shingle, ({end})::UBIGINT AS h FROM ends)"""


def _shingles(width: int) -> str:
    """The shingles of ``words``; fewer words are one, no words none."""
    return f"""CASE WHEN len(words) = 0 THEN []
                        ELSE [array_to_string(words[i:i + {width - 1}], ' ') FOR i IN range(1, greatest(2, len(words) - {width - 2}))] END"""


SIMHASH = f"""
        WITH RECURSIVE {_CUT},
        shingles AS (SELECT row_no, unnest({_shingles(3)}) AS shingle FROM cut),
        {_xxh64_steps("shingles", 42).strip()},
        bits AS (
          SELECT row_no, bit, sum((h >> bit::UBIGINT & 1)::INTEGER) * 2 > count(*) AS is_set
          FROM shingles JOIN hashed USING (shingle), range(64) AS bits(bit) GROUP BY row_no, bit),
        prints AS (
          SELECT row_no, doc_id, coalesce(fp, 0)::UBIGINT AS fp
          FROM cut LEFT JOIN (SELECT row_no, sum(1::HUGEINT << bit::HUGEINT) FILTER (is_set) AS fp
                              FROM bits GROUP BY row_no) USING (row_no)),
        classes AS (SELECT fp AS c, min(doc_id) AS least FROM prints GROUP BY fp),
        links AS (SELECT a.c AS a, b.c AS b FROM classes a JOIN classes b ON a.c < b.c AND bit_count(xor(a.c, b.c)) <= 2),
        {_ROOTS}
        SELECT doc_id, lower(lpad(hex(fp), 16, '0')) AS fingerprint, root AS component_id
        FROM prints JOIN roots ON roots.c = prints.fp"""

MINHASH = f"""
        WITH RECURSIVE {_CUT},
        sets AS (
          SELECT row_no, doc_id, list_sort(list_distinct(
                   {_shingles(5)})) AS shingles
          FROM cut),
        classes AS (
          SELECT shingles, len(shingles) AS n, min(doc_id) AS least, row_number() OVER () AS c
          FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
        posts AS (SELECT c, n, unnest(shingles) AS shingle FROM classes),
        shared AS (
          SELECT a.c AS a, b.c AS b, a.n + b.n AS sizes, count(*) AS m
          FROM posts a JOIN posts b ON a.shingle = b.shingle AND a.c < b.c
          WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
          GROUP BY ALL),
        links AS (SELECT a, b FROM shared WHERE 100 * m >= 85 * (sizes - m)),
        {_ROOTS},
        named AS (
          SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE root END AS component_id
          FROM sets s LEFT JOIN classes k ON k.shingles = s.shingles LEFT JOIN roots ON roots.c = k.c)
        SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM named"""
