"""The registered queries of the operators and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers

from veritab.llm import centroids, embedding_join, exact_dedup, language, learned_partitions, merkle, mixing, ngram_join, packing, repeats, secrets, toxicity, warc

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op3_exact_dedup",
    """SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size, doc_id = MAX(doc_id) OVER g AS kept,
              sha256(t) AS text_sha256
       FROM (SELECT doc_id, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
             FROM documents)
       WINDOW g AS (PARTITION BY t)""",
)
def op3(spark, folder):
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents")).drop("owner")


@query("op6_packing")
def op6(spark, folder):
    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path(packing.VOCABULARY), with_ids=False)


@query(
    "op10_mixing",
    r"""WITH sized AS (
            SELECT doc_id, source, md5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS t0, COALESCE(md5(text), '') AS t1,
                   CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents),
        sources AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        weighted AS (
            SELECT *, 1 + (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, CAST(SUM(source_size) OVER () AS BIGINT) AS total
            FROM sources),
        ordered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM weighted),
        stepped AS (
            SELECT a.*, a.total - COALESCE((SELECT SUM(3 * b.source_size) FROM ordered b WHERE b.k < a.k), 0) AS left_size,
                   (SELECT SUM(b.weight) FROM ordered b WHERE b.k >= a.k) AS left_weight
            FROM ordered a),
        capped AS (SELECT *, 3 * source_size * left_weight <= weight * left_size AS is_full FROM stepped),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
                        ELSE CAST(weight * (total - COALESCE(SUM(CASE WHEN is_full THEN 3 * source_size END) OVER (), 0)) AS DOUBLE)
                             / CAST(SUM(CASE WHEN NOT is_full THEN weight END) OVER () AS DOUBLE) END AS target,
                   CAST('0x' || substr(md5('mix:' || COALESCE('=' || source, '')), 1, 5) AS BIGINT) / 1048576.0 AS u
            FROM capped),
        rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
        ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY size, t0, t1) AS r FROM sized)
        SELECT d.doc_id, d.size, s.source_size, s.target,
               CAST(floor(s.rate * d.r + s.u) - floor(s.rate * (d.r - 1) + s.u) AS BIGINT) * d.size AS taken,
               CAST(floor(s.rate * d.r + s.u) - floor(s.rate * (d.r - 1) + s.u) AS BIGINT) AS copies
        FROM ranked d JOIN rated s ON d.source IS NOT DISTINCT FROM s.source""",
)
def op10(spark, folder):
    return mixing.mix_documents(_table(spark, folder, "documents"))


@query(
    "op1_warc",
    """SELECT page_id, strlen(h) AS payload_bytes,
              array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + CAST(16 * CAST(bits[5 * i + 1] AS INTEGER) + 8 * CAST(bits[5 * i + 2] AS INTEGER) + 4 * CAST(bits[5 * i + 3] AS INTEGER)
                           + 2 * CAST(bits[5 * i + 4] AS INTEGER) + CAST(bits[5 * i + 5] AS INTEGER) AS INTEGER), 1)), '') AS payload_digest,
              CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
              CASE WHEN page_id <> best THEN best END AS refers_to
       FROM (SELECT page_id, h, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(d, i, 1) AS BIGINT)), 4, '0')), '') AS bits, MAX(page_id) OVER (PARTITION BY h) AS best FROM
             (SELECT page_id, COALESCE(html, '') AS h, sha1(COALESCE(html, '')) AS d FROM pages))""",
)
def op1(spark, folder):
    return warc.archive_round_trip(_table(spark, folder, "pages"))


@query(
    "op7_secret_scan",
    r"""WITH rules(number, kind, pattern, least) AS (VALUES
            (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)', 8),
            (1, 'access', '(AKIA)([A-Z0-9]+)', 12), (2, 'hex', '()([0-9a-f]+)', 32)),
        matched AS (
            SELECT doc_id, number, kind, least, string_split_regex(t, pattern) AS gaps, regexp_extract_all(t, pattern, 0) AS whole,
                   regexp_extract_all(t, pattern, 2) AS measured
            FROM (SELECT doc_id, COALESCE(text, '') AS t FROM documents), rules),
        each AS (
            SELECT doc_id, number, kind, least, unnest(range(1, len(whole) + 1)) AS i, length(unnest(gaps[:len(whole)])) AS gap,
                   length(unnest(whole)) AS n, length(unnest(measured)) AS m
            FROM matched),
        placed AS (SELECT *, SUM(gap + n) OVER (PARTITION BY doc_id, number ORDER BY i) AS e FROM each),
        kept AS (SELECT doc_id, number, e - n AS s, kind || ':' || CAST(e - n AS BIGINT) || ':' || CAST(e AS BIGINT) AS span FROM placed WHERE m >= least),
        listed AS (
            SELECT doc_id, COUNT(*) FILTER (number = 0) AS n_assign, COUNT(*) FILTER (number = 1) AS n_access,
                   COUNT(*) FILTER (number = 2) AS n_hex, string_agg(span, ',' ORDER BY s, number) AS spans
            FROM kept GROUP BY doc_id)
        SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
               sha256(COALESCE(spans, '')) AS base_sha256, COALESCE(spans, '') AS spans
        FROM documents d LEFT JOIN listed l USING (doc_id)""".replace("\\'", "''"),
)
def op7(spark, folder):
    return secrets.secret_report(_table(spark, folder, "documents"))


@query(
    "op8_embedding_join",
    """WITH RECURSIVE sound AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
        counted AS (SELECT x, COUNT(*) AS n FROM links GROUP BY x)
        SELECT r.x AS vec_id, COALESCE(MAX(n), 0) AS n_links, MIN(r.y) AS component_id, MIN(r.y) = r.x AS kept
        FROM reach r LEFT JOIN counted c ON c.x = r.x GROUP BY r.x""",
)
def op8(spark, folder):
    return embedding_join.near_embeddings(_table(spark, folder, "embeddings"))


@query(
    "op9_ngram_join",
    r"""WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
            FROM worded),
        each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, COUNT(*) AS c
            FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM common WHERE 100 * c >= 85 * (n + m - c)),
        reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, MIN(y) AS component_id FROM sets JOIN reach ON x = doc_id GROUP BY ALL""",
)
def op9(spark, folder):
    return ngram_join.near_duplicates(_table(spark, folder, "documents"))


@query("op5_repeat_removal")
def op5(spark, folder):
    return repeats.remove_repeats(_table(spark, folder, "documents")).drop("kept_text")


@query("op4_toxicity")
def op4(spark, folder):
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, folder, "labels")))


@query("op2_language_id")
def op2(spark, folder):
    model = language.fit_text_model(_table(spark, folder, "documents"))
    return language.identify_pages(_table(spark, folder, "pages"), model)


def _clustering_sql(rounds: int = centroids.ROUNDS) -> str:
    """Integer clustering, one set of common table expressions for each round."""
    cut = "CASE WHEN {s} % {n} < 0 THEN {s} // {n} - 1 ELSE {s} // {n} END"  # // cuts towards zero
    parts = [
        """v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
                FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "c0 AS (SELECT ROW_NUMBER() OVER (ORDER BY h, x) - 1 AS k, x FROM (SELECT x, sha256('1:' || vec_id) AS h FROM v ORDER BY h, x LIMIT 16))",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS (SELECT vec_id, v.x, arg_min(k, (d, k)) AS k, MIN(d) AS d
                FROM (SELECT vec_id, v.x, k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{r} c) v
                GROUP BY vec_id, v.x)"""
        )
        if r < rounds:
            parts.append(
                f"""m{r} AS (SELECT k, list({cut.format(s="s", n="n")} ORDER BY i) AS x
                    FROM (SELECT k, i, SUM(y)::BIGINT AS s, COUNT(*) AS n FROM (SELECT k, unnest(x) AS y, unnest(range(64)) AS i FROM a{r}) GROUP BY k, i) GROUP BY k)"""
            )
            parts.append(f"c{r + 1} AS (SELECT c.k, COALESCE(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (k))")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(SUM(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
               CAST(SUM(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} c USING (k)"""


@query("op11_learned_partitions")
def op11(spark, folder):
    vectors = _table(spark, folder, "embeddings")
    return learned_partitions.nearest(vectors, learned_partitions.train(vectors))


@query("op12_simplex_clustering", _clustering_sql())
def op12(spark, folder):
    return centroids.cluster(_table(spark, folder, "embeddings"))


@query(
    "op13_merkle_manifest",
    r"""WITH RECURSIVE coded AS (
            SELECT doc_id, source, text, ROW_NUMBER() OVER () AS row,
                   list_reduce(list_concat([4294967295], range(8 * strlen(CAST(doc_id AS VARCHAR)))), lambda c, i:
                       (CASE WHEN (CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS INTEGER), 1)) AS BIGINT)) ELSE c END) & 1 = 1
                        THEN xor((CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS INTEGER), 1)) AS BIGINT)) ELSE c END) >> 1, 3988292384)
                        ELSE (CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS INTEGER), 1)) AS BIGINT)) ELSE c END) >> 1 END)) AS crc_inverse,
                   [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)] AS others
            FROM documents),
        prepared AS (
            SELECT *, array_to_string(list_transform(others, lambda x: CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END), '') AS head,
                   CASE WHEN COALESCE(crc_inverse & 1 = 1, FALSE) THEN replace(text, chr(10), '') ELSE text END AS other_text
            FROM coded),
        hashed AS (
            SELECT doc_id, source, row, sha256(head || COALESCE(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || COALESCE(strlen(other_text) || ':' || other_text, '-')) AS changed
            FROM prepared),
        leaves AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS idx, COUNT(*) OVER (PARTITION BY source) AS n,
                   DENSE_RANK() OVER (ORDER BY source NULLS FIRST) AS tree
            FROM hashed),
        nodes(lvl, tree, idx, n, h) AS (
            SELECT 0, tree, idx, n, leaf FROM leaves
            UNION ALL
            SELECT lvl + 1, tree, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY lvl, tree, idx // 3, n),
        upper(lvl, tree, idx, n, h) AS (
            SELECT 0, 0, tree - 1, COUNT(*) OVER (), h FROM nodes WHERE n = 1
            UNION ALL
            SELECT lvl + 1, tree, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY lvl, tree, idx // 3, n),
        runs AS (
            SELECT tree, lvl, idx // 3 AS run, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 3
            UNION ALL SELECT tree, lvl, idx // 3, list(h ORDER BY idx) FROM upper WHERE n > 1 GROUP BY tree, lvl, idx // 3),
        folded(row, own_tree, tree, lvl, idx, h, proof, going) AS (
            SELECT row, tree, tree, 0, idx, changed, '', TRUE FROM leaves
            UNION ALL
            SELECT row, own_tree, CASE WHEN r.run IS NULL THEN 0 ELSE f.tree END, CASE WHEN r.run IS NULL THEN 0 ELSE f.lvl + 1 END,
                   CASE WHEN r.run IS NULL THEN own_tree - 1 ELSE f.idx // 3 END,
                   CASE WHEN r.run IS NULL THEN h ELSE sha256(array_to_string(hs[1:f.idx % 3], '') || h || array_to_string(hs[f.idx % 3 + 2:], '')) END,
                   proof || CASE WHEN r.run IS NULL THEN '' ELSE array_to_string(hs[1:f.idx % 3], '') || array_to_string(hs[f.idx % 3 + 2:], '') END,
                   NOT (r.run IS NULL AND f.tree = 0)
            FROM folded f LEFT JOIN runs r ON r.tree = f.tree AND r.lvl = f.lvl AND r.run = f.idx // 3
            WHERE going)
        SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
        FROM leaves l JOIN folded f USING (row) JOIN nodes s ON s.tree = l.tree AND s.n = 1 JOIN upper t ON t.n = 1
        WHERE NOT f.going""",
)
def op13(spark, folder):
    rows = merkle.merkle_manifest(_table(spark, folder, "documents"), tampered=merkle.line_breaks_removed())
    return rows.drop("path")
