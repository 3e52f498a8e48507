"""DuckDB SQL for the registered queries of this subpackage."""

from __future__ import annotations

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = (
    "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def words_of(text: str) -> str:
    return f"regexp_extract_all({LOWER.format(text)}, '{WORD}')"


def contamination(docs: str = "documents", window: int = 13) -> str:
    """CTEs that end in ``judged``: one row per row of ``docs``."""
    cut = f"greatest(len(w) - {window - 1}, 1)"
    gram = f"array_to_string(w[i:i + {window - 1}], ' ')"
    return f"""
    dw AS (SELECT row_number() OVER () AS r, doc_id, {words_of("text")} AS w FROM {docs}),
    bw AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {words_of("text")} AS w
           FROM benchmark),
    phrases AS (SELECT DISTINCT item, {gram} AS p, least(len(w), {window}) AS k
                FROM (SELECT item, w, unnest(range(1, {cut} + 1)) AS i FROM bw WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT k FROM phrases),
    spans AS (SELECT d.r, d.i, p.k, p.item
              FROM (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
                    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
                          FROM dw, sizes WHERE len(w) >= k)) AS d
              JOIN phrases AS p ON p.p = d.p AND p.k = d.k),
    hit AS (SELECT r, count(DISTINCT j) AS n_hit
            FROM (SELECT r, unnest(range(i, i + k)) AS j FROM spans) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT r, item FROM spans) GROUP BY r),
    judged AS (SELECT dw.r, dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words,
                      coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
                      sha256(coalesce(items, '')) AS items_sha256,
                      coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(dw.w) AS contaminated
               FROM dw LEFT JOIN hit USING (r) LEFT JOIN named USING (r))"""


def hashed(*parts: str) -> str:
    joined = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 12) AS BIGINT)"


def mixture(docs: str = "documents", target: float = 0.95, repeats: float = 4.0) -> str:
    """CTEs that end in ``drawn``: the draws of the temperature mixture."""
    middle = "(lo + hi) / 2"
    entropy = (
        f"(SELECT ln(sum(pow(share, {middle}))) - {middle} * sum(pow(share, {middle}) * ln(share)) "
        f"/ sum(pow(share, {middle})) FROM shares)"
    )
    most = f"(SELECT max(pow(share, {middle} - 1)) / sum(pow(share, {middle})) FROM shares)"
    return f"""
    counted AS MATERIALIZED (
        SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, doc_id, coalesce(source, '') AS source,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f]+')) AS BIGINT) AS n_tokens
        FROM {docs}),
    shares AS MATERIALIZED (
        SELECT source, tokens, tokens / sum(tokens) OVER () AS share, sum(tokens) OVER () AS total
        FROM (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY source)
        WHERE tokens > 0),
    halved AS (
        SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
        UNION ALL
        SELECT i + 1, CASE WHEN up THEN {middle} ELSE lo END, CASE WHEN up THEN hi ELSE {middle} END
        FROM (SELECT *, {entropy} > {target} * (SELECT ln(count(*)) FROM shares) AS up FROM halved WHERE i < 40)),
    limited AS (
        SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
        UNION ALL
        SELECT i + 1, CASE WHEN up THEN {middle} ELSE lo END, CASE WHEN up THEN hi ELSE {middle} END
        FROM (SELECT *, {most} > {repeats} AS up FROM limited WHERE i < 40)),
    chosen AS MATERIALIZED (
        SELECT greatest((SELECT round(hi, 9) FROM halved WHERE i = 40),
                        (SELECT round(hi, 9) FROM limited WHERE i = 40)) AS a),
    budgets AS MATERIALIZED (
        SELECT source, tokens, least(CAST(ceil(tokens / 65536) AS BIGINT), 4096) AS blocks,
               CAST(round(pow(share, a) / sum(pow(share, a)) OVER () * total) AS BIGINT) AS budget
        FROM shares, chosen),
    placed AS (
        SELECT c.*, b.tokens, b.budget, {hashed("'mix'", "'block'", "id")} % blocks AS block,
               unnest(range(0, CASE WHEN budget > 0 THEN (budget - 1) // tokens + 1 ELSE 0 END)) AS epoch
        FROM counted c JOIN budgets b USING (source)),
    in_block AS (
        SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch, block
            ORDER BY {hashed("'mix'", "epoch", "id")}, doc_id, n_tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM placed),
    starts AS (
        SELECT source, epoch, block, coalesce(sum(t) OVER (PARTITION BY source, epoch
            ORDER BY {hashed("'mix'", "epoch", "source", "block")}, block
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block_start
        FROM (SELECT source, epoch, block, sum(n_tokens) AS t FROM placed GROUP BY ALL)),
    drawn AS (
        SELECT doc_id, source, n_tokens, epoch, block,
               CAST(epoch * tokens + block_start + ahead AS BIGINT) AS "start",
               CAST(epoch * tokens + block_start + ahead AS BIGINT) / budget AS "at"
        FROM in_block JOIN starts USING (source, epoch, block)
        WHERE epoch * tokens + block_start + ahead < budget)"""


def similarity(docs: str = "documents") -> str:
    """CTEs that end in ``joined``: groups and links at Jaccard 0.8 or more."""
    cut = "greatest(len(w) - 4, least(len(w), 1))"
    return f"""
    dw AS MATERIALIZED (SELECT doc_id, {words_of("text")} AS w FROM {docs}),
    ds AS MATERIALIZED (
        SELECT doc_id, list_sort(list_distinct(
            [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, {cut} + 1)])) AS s FROM dw),
    classes AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY min(doc_id)) AS c, s, min(doc_id) AS rep, count(*) AS copies
        FROM ds GROUP BY s),
    tokens AS MATERIALIZED (SELECT c, len(s) AS n, unnest(s) AS t FROM classes),
    pairs AS MATERIALIZED (
        SELECT a.c AS a, b.c AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.c <> b.c
        WHERE 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
        GROUP BY a.c, b.c, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))),
    reached AS (SELECT c AS a, c AS b FROM classes
                UNION SELECT r.a, p.b FROM reached r JOIN pairs p ON r.b = p.a),
    grouped AS (SELECT a AS c, min(rep) AS class_id FROM reached JOIN classes ON classes.c = b GROUP BY a),
    linked AS (SELECT a AS c, count(*) AS sets, sum(copies) AS docs FROM pairs JOIN classes ON c = b GROUP BY a),
    joined AS (
        SELECT ds.doc_id, class_id, rep AS set_id,
               CAST(coalesce(linked.docs, 0) + copies - 1 AS BIGINT) AS n_links,
               CAST(coalesce(linked.sets, 0) AS BIGINT) AS n_linked_sets
        FROM ds JOIN classes USING (s) JOIN grouped USING (c) LEFT JOIN linked USING (c))"""


def paragraphs(docs: str = "documents") -> str:
    """CTEs that end in ``removed`` (doc_id, line): paragraphs of 30 words or
    more that repeat an earlier one, by components of Jaccard 0.8 or more."""
    return f"""
    lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t,
                     generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM {docs}),
    pw AS (SELECT doc_id, line, {words_of("t")} AS w FROM lines),
    ps AS MATERIALIZED (
        SELECT doc_id, line, list_sort(list_distinct(
            [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])) AS s FROM pw WHERE len(w) >= 30),
    pclasses AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY min(ROW(doc_id, line))) AS c, s, min(ROW(doc_id, line)) AS first
        FROM ps GROUP BY s),
    ptokens AS MATERIALIZED (SELECT c, len(s) AS n, unnest(s) AS t FROM pclasses),
    ppairs AS MATERIALIZED (
        SELECT a.c AS a, b.c AS b FROM ptokens a JOIN ptokens b ON a.t = b.t AND a.c <> b.c
        GROUP BY a.c, b.c, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))),
    preached AS (SELECT c AS a, c AS b FROM pclasses
                 UNION SELECT r.a, p.b FROM preached r JOIN ppairs p ON r.b = p.a),
    pheads AS (SELECT a AS c, min(first) AS head FROM preached JOIN pclasses ON pclasses.c = b GROUP BY a),
    removed AS (SELECT doc_id, line FROM ps JOIN pclasses USING (s) JOIN pheads USING (c)
                WHERE ROW(doc_id, line) <> head)"""


def whole_vectors(scale: int, extra: str) -> str:
    """A query of the usable vectors, times ``scale`` and rounded down."""
    return f"""SELECT vec_id, {extra} AS label,
               [floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0"""


def hard_negatives() -> str:
    """CTEs that end in ``mined``."""
    moved = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return f"""
    v AS MATERIALIZED (SELECT * FROM ({whole_vectors(256, moved)}) WHERE label IS NOT NULL),
    scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
               CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place
                       FROM scored WHERE same) WHERE place <= 5),
    mined AS (
        SELECT * FROM (
            SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score,
                   s.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS "rank"
            FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 80 * p.score <= 100 * s.score AND s.score <= p.score) WHERE "rank" <= 5)"""


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """CTEs that end in ``coded``."""
    size = f"(len(e) // {parts})"
    books = f"""
    v AS MATERIALIZED ({whole_vectors(1024, "label")}),
    pieces AS MATERIALIZED (
        SELECT vec_id, label, p, [CAST(y AS BIGINT) FOR y IN e[p * {size} + 1 : (p + 1) * {size}]] AS x
        FROM v, range({parts}) AS t(p)),
    book0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c
        FROM pieces QUALIFY k < {entries})"""

    def nearest(book: str) -> str:
        apart = "list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)])"
        return f"""SELECT vec_id, label, p, x, min(ROW(CAST({apart} AS BIGINT), k)) AS best
        FROM pieces JOIN {book} USING (p) GROUP BY vec_id, label, p, x"""

    for n in range(rounds):
        books += f""",
    near{n} AS MATERIALIZED ({nearest(f"book{n}")}),
    means{n} AS (
        SELECT p, k, list(m ORDER BY i) AS m
        FROM (SELECT p, k, i, CAST(floor(sum(y) / count(*)) AS BIGINT) AS m
              FROM (SELECT p, best[2] AS k, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM near{n})
              GROUP BY p, k, i) GROUP BY p, k),
    book{n + 1} AS MATERIALIZED (
        SELECT p, k, coalesce(m, c) AS c FROM book{n} LEFT JOIN means{n} USING (p, k))"""
    return f"""{books},
    final AS MATERIALIZED ({nearest(f"book{rounds}")}),
    whole AS (
        SELECT vec_id, label, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code,
               CAST(sum(best[1]) AS BIGINT) AS error FROM final GROUP BY vec_id, label),
    digest AS (
        SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book{rounds}),
    coded AS (
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               codebooks_sha256 FROM whole, digest)"""


SQL: dict[str, str] = {
    "op12_hard_negatives": f"""WITH {hard_negatives()}
    SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score FROM mined""",
    "op13_vector_codes": f"WITH {vector_codes()} SELECT * FROM coded",
    "op4_jaccard_join": f"WITH RECURSIVE {similarity()} SELECT * FROM joined",
    "op1_mixing": f"WITH RECURSIVE {mixture()} SELECT * FROM drawn",
    "op6_warc": """WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
    best AS (SELECT hex, max(page_id) AS response FROM p GROUP BY hex),
    parts AS (SELECT *, [CAST('0x' || substr(hex, i, 5) AS INTEGER) FOR i IN range(1, 41, 5)] AS v
              FROM p JOIN best USING (hex))
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
           array_to_string(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((x >> s) & 31), 1) FOR s IN [15, 10, 5, 0]] FOR x IN v]), '') AS payload_digest,
           CASE WHEN page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
    FROM parts""",
    "op10_decontamination": f"""WITH {contamination()}
    SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM judged""",
}
