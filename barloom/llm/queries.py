"""The registered queries of the corpus operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, collocations, exact_dedup, fingerprints, hpylm, jaccard, langid, mixing, nra, simhash, suffix_dedup, token_counts, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_kept=False)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score_texts(_table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.fit_and_identify(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(_table(spark, sf_dir, "documents"), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_fingerprints": op6_fingerprints,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_warc": op9_warc,
    "op10_mixing": op10_mixing,
    "op11_collocations": op11_collocations,
    "op12_simhash": op12_simhash,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(generate_series(0, len(h) // 2 - 100)) AS i FROM d WHERE len(h) >= 200)),
        r AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
        n AS (SELECT *, CASE WHEN i <= lag(i) OVER o + 100 THEN 0 ELSE 1 END AS new FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        g AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM n) GROUP BY doc_id, g),
        k AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM g),
        t AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) || substr(any_value(h), 2 * max(hi) + 1) AS kept, sum(hi - lo) AS removed, count(*) AS spans FROM k JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
        FROM d LEFT JOIN t USING (doc_id)""",
    "op3_jaccard_join": r"""
        WITH RECURSIVE
        w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
        g AS (SELECT min(doc_id) AS rep, any_value(s) AS s, list_sort(s) AS k FROM s WHERE len(s) > 0 GROUP BY k),
        t AS (SELECT rep, len(s) AS n, unnest(s) AS t FROM g),
        p AS (SELECT a.rep AS a, b.rep AS b FROM t a JOIN t b ON a.t = b.t AND a.rep <> b.rep
              GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
        r AS (SELECT rep AS a, rep AS b FROM g UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
        c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id
        FROM s LEFT JOIN g ON len(s.s) > 0 AND list_sort(s.s) = g.k LEFT JOIN c ON c.a = g.rep""",
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN strlen(html) >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(html) >= 1000 AND page_id <> keep THEN keep END AS refers_to
        FROM k""",
    "op11_collocations": r"""
        WITH w AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
                   FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        g AS (SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS f
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
        c AS (SELECT * FROM g WHERE k > 1 AND f >= 30),
        inner_of AS (SELECT DISTINCT lang, f, p[i:i + m - 1] AS p FROM (SELECT lang, f, p, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)),
        gone AS (SELECT DISTINCT c.lang, c.p FROM c JOIN inner_of o ON o.lang = c.lang AND o.p = c.p WHERE 100 * o.f >= 80 * c.f),
        cuts AS (SELECT c.lang, c.p, c.f AS a, j, x.f AS l, y.f AS r, CAST(2000000 * CAST(c.f AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
                 FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN g x ON x.lang = c.lang AND x.p = c.p[1:j] JOIN g y ON y.lang = c.lang AND y.p = c.p[j + 1:]),
        best AS (SELECT * FROM cuts ANTI JOIN gone USING (lang, p) QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM best JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op13_lexical_search": r"""
        WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
        p AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
        len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY doc_id),
        s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
        w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * (SELECT docs FROM s) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p GROUP BY t),
        q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
        m AS (SELECT item_id, t, count(*) AS times FROM q GROUP BY ALL),
        x AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
              FROM m JOIN w USING (t) JOIN p USING (t) JOIN len USING (doc_id), s GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0 QUALIFY rank <= 10""",
}
