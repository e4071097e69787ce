"""Queries on clusters of embeddings, packed sequences and fill-in-middle texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.boundaries import fill_in_middle
from tidemark.llm.centroids import cluster_vectors
from tidemark.llm.packing import pack_documents
from tidemark.llm.registry import query, read


def _kmeans_sql(size: int, k: int, rounds: int) -> str:
    """The rounds one after the other, over (vector, component) rows."""

    def assigned(n: int) -> str:
        return f"""
    a{n} AS MATERIALIZED (
        SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT r, c, sum((q.v - m.v) * (q.v - m.v))::HUGEINT AS d FROM q JOIN m{n} m USING (i) GROUP BY r, c
        ) GROUP BY r
    )"""

    def moved(n: int) -> str:
        return f"""
    m{n + 1} AS MATERIALIZED (
        SELECT m.c, m.i, coalesce((s - ((s % t) + t) % t) // t, m.v)::HUGEINT AS v FROM m{n} m LEFT JOIN (
            SELECT c, i, sum(v)::HUGEINT AS s, count(*)::HUGEINT AS t FROM a{n} JOIN q USING (r) GROUP BY c, i
        ) USING (c, i)
    )"""

    steps = "".join(f"{assigned(n)},{moved(n)}," for n in range(rounds))
    return f"""
    WITH e AS (
        SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
        WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
    ),
    q AS MATERIALIZED (
        SELECT r, generate_subscripts(embedding, 1) AS i, floor(256 * unnest(embedding)::DOUBLE)::HUGEINT AS v FROM e
    ),
    starts AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM e),
    m0 AS MATERIALIZED (SELECT c, i, v FROM starts JOIN q USING (r) WHERE c < {k}),
    {steps}{assigned(rounds)}
    SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance,
           (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
    FROM a{rounds} JOIN e USING (r)
    JOIN (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM m{rounds} GROUP BY c) USING (c)
    """


@query("op11_cluster_vectors", _kmeans_sql(64, 40, 5))
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read(spark, sf_dir, "embeddings"))


@query("op12_pack_sequences")
def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op13_fill_in_middle", """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
               sha256('1:' || doc_id) AS x
        FROM documents
    ),
    h AS (
        SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
               ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
        FROM d
    ),
    c AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM h
    ),
    p AS (
        SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid,
               array_to_string(u[b + 1:n], '') AS suf
        FROM c
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
""")
def infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(read(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
