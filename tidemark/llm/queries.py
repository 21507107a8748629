"""The operators as queries over whole tables, and as SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import ann, audit, clusters, decontaminate, html, language, minhash, mixing, pii, simhash, substrings, toxicity, warc
from tidemark.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = language.label(docs.select("doc_id", "text"), language.fit(docs), ("lang_pred", "score", "shares"))
    parts = F.transform(F.map_entries("shares"), lambda s: F.concat(s["key"], F.lit(":"), F.format_string("%.4f", s["value"])))
    held_out = language.held_out(F.col("doc_id")).alias("held_out")
    return labelled.select("doc_id", held_out, "lang_pred", "score", F.array_join(parts, ",").alias("lang_shares"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    found = mixing.taken(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captures of all pages, as read back from their archives."""
    index = warc.archive_and_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document covers, and how much of them."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without repeated passages."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of each row whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of each vector after three rounds."""
    return clusters.clustering(table(spark, sf_dir, "embeddings"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document under similarity of its shingle sets."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, by source."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_language,
        op3_source_mix,
        op4_personal_data,
        op5_warc,
        op6_simhash,
        op7_decontamination,
        op8_substrings,
        op9_nearest,
        op10_main_text,
        op11_centroids,
        op12_minhash,
        op13_filter_audit,
    )
}

def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Assignments and exact means round by round, as common tables."""
    parts = [
        """x AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS HUGEINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
        )""",
        "v AS (SELECT r, unnest(range(0, 64)) AS i, unnest(q) AS q FROM x)",
        f"""s AS (
            SELECT r, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), q) - 1 AS c FROM x
            QUALIFY c < {k}
        )""",
        "c0 AS (SELECT s.c, v.i, v.q FROM s JOIN v ON s.r = v.r)",
    ]
    for n in range(rounds + 1):
        parts += [
            f"d{n} AS (SELECT v.r, c.c, sum((v.q - c.q) * (v.q - c.q)) AS d FROM v JOIN c{n} c ON v.i = c.i GROUP BY v.r, c.c)",
            f"a{n} AS (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)",
            f"m{n} AS (SELECT a.c, v.i, CAST(sum(v.q) AS HUGEINT) AS t, CAST(count(*) AS HUGEINT) AS n FROM a{n} a JOIN v ON a.r = v.r GROUP BY a.c, v.i)",
            # The remainder made positive, so that the quotient is the floor.
            f"c{n + 1} AS (SELECT c.c, c.i, coalesce((m.t - (m.t % m.n + m.n) % m.n) // m.n, c.q) AS q FROM c{n} c LEFT JOIN m{n} m ON c.c = m.c AND c.i = m.i)",
        ]
    return f"""
        WITH {", ".join(parts)},
        h AS (SELECT c, sha256(string_agg(CAST(q AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
        SELECT x.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
               CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
        FROM a{rounds} a JOIN x ON a.r = x.r JOIN h ON a.c = h.c"""


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE = {
    "op5_warc": f"""
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
        ), d AS (
            SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
                substr('{_BASE32}', 1 + CAST(list_sum(list_transform(range(0, 5), lambda b:
                    (((strpos('0123456789abcdef', substr(h, CAST((5 * i + b) // 4 AS INTEGER) + 1, 1)) - 1)
                      // CAST(pow(2, 3 - (5 * i + b) % 4) AS INTEGER)) % 2) * CAST(pow(2, 4 - b) AS INTEGER))) AS INTEGER), 1)), '')
                AS payload_digest
            FROM p
        ), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM f""",
    "op8_substrings": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
        g AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM p),
        f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM g),
        c AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS gone FROM f WHERE n > 1 GROUP BY doc_id),
        k AS (
            SELECT d.doc_id, w, coalesce(c.gone, []) AS gone FROM d LEFT JOIN c ON c.doc_id = d.doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
               sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
        FROM k""",
    "op9_nearest": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_centroids": _clusters_sql(),
    "op12_minhash": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g
            FROM d
        ), k AS (SELECT min(doc_id) AS rep, len(list_sort(g)) AS n, list_sort(g) AS g FROM s WHERE len(g) > 0 GROUP BY list_sort(g)),
        e AS (SELECT rep, n, unnest(g) AS x FROM k),
        p AS (
            SELECT a.rep AS a, b.rep AS b FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), l AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
        t(node, root) AS (SELECT rep, rep FROM k UNION SELECT l.b, t.root FROM t JOIN l ON t.node = l.a),
        c AS (SELECT node, min(root) AS root FROM t GROUP BY node)
        SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id,
               s.doc_id = coalesce(c.root, s.doc_id) AS kept
        FROM s LEFT JOIN k ON len(s.g) > 0 AND list_sort(s.g) = k.g LEFT JOIN c ON c.node = k.rep""",
    "op13_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), g AS (
            SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id
        ), f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
                    coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS bad
            FROM d LEFT JOIN g ON d.doc_id = g.doc_id
        ), m AS (SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, bad),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x)
            JOIN l d ON d.x NOT IN (a.x, b.x, c.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)
        ), q AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
        z AS (SELECT filter_order, step, strpos('ABCDE', substr(filter_order, CAST(step AS INTEGER), 1)) AS x FROM q),
        r AS (
            SELECT part, filter_order, step, x, n, good, toxic, bad[x] AS here, len(list_filter(bad, lambda y: y)) AS fails,
                   len(list_filter(range(1, step), lambda y: bad[strpos('ABCDE', substr(filter_order, CAST(y AS INTEGER), 1))])) > 0 AS before
            FROM m CROSS JOIN z
        ), c AS (
            SELECT part, filter_order, step, x, sum(CASE WHEN NOT here AND NOT before THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN here AND NOT before THEN n ELSE 0 END) AS removed, sum(CASE WHEN here AND before THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN here AND fails = 1 THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN here AND NOT before THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN here AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
            FROM r GROUP BY part, filter_order, step, x
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
        FROM c""",
}
