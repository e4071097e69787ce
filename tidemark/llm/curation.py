"""Queries on duplicates, benchmark passages and the mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.decontaminate import contaminated_words
from tidemark.llm.exact import exact_duplicates
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near import near_duplicates
from tidemark.llm.registry import query, read


@query("op9_exact_dedup", r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, text_sha256
    FROM d
    WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id)
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


@query("op7_mix_sources")
def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op3_decontaminate", f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    win AS (
        SELECT DISTINCT item_id, w[s:s + 9] AS x
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
    ),
    runs AS (
        SELECT doc_id, s, w[s:s + n - 1] AS x
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
              FROM d, (SELECT DISTINCT len(x) AS n FROM win))
    ),
    hits AS (SELECT doc_id, item_id, s, len(x) AS n FROM runs JOIN win USING (x)),
    cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
    its AS (SELECT doc_id, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_words(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_list", ","), 256).alias("items_sha256"), "contaminated",
    )


_BLANK_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query("op8_near_dedup", f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_BLANK_WORDS} AS w FROM documents),
    sh AS (
        SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                                       ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END) AS s FROM d)
    ),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    links AS (
        SELECT x, y FROM (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2)
        JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
        WHERE 100 * c >= 80 * (nx.n + ny.n - c)
    ),
    reach(doc_id, r) AS (
        SELECT doc_id, doc_id FROM d UNION SELECT x, r FROM reach JOIN links ON y = reach.doc_id
    )
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
    FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
""")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=4)
