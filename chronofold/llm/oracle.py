"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from chronofold.llm import pipeline

ORACLE_SQL: dict[str, str] = {
    "op3_urls": r"""
        WITH rules(verdict, rule_host, rule_path) AS (
            VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                   ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ), rest AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
                   row_number() OVER () AS n
            FROM pages
        ), parts AS (
            SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM rest
        ), fits AS (
            SELECT p.*, rule_host || rule_path AS rule, verdict,
                   row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
            FROM parts p LEFT JOIN rules r
              ON ('.' || p.host) LIKE ('%.' || r.rule_host) AND starts_with(p.path, r.rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
    """,
    "op7_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents
        ), groups AS (
            SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id
            FROM rows GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM rows JOIN groups USING (text_sha256)
    """,
    "op9_chat": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), sized AS (
            SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '</turn>', '&end;'), '#', '&num;'))
                      + length(replace(replace(replace(replace(role, '&', '&amp;'), '</turn>', '&end;'), '#', '&num;'), ':', '&col;'))
                      + 14 AS chars
            FROM said
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
}


def _apart(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, 65), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))::BIGINT"


def _centroids(rounds: int = 3, clusters: int = 16) -> str:
    """Rounds written out one after the other."""
    parts = [
        """ints AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM ints
            QUALIFY k < {clusters}
        )""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
                SELECT n, arg_min(k, (d, k)) AS k, min(d) AS d
                FROM (SELECT n, c.k, {_apart("i.v", "c.v")} AS d FROM ints i CROSS JOIN c{r} c) GROUP BY n
            )"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
                    SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
                        SELECT k, list(((s - ((s % z) + z) % z) // z)::BIGINT ORDER BY p) AS v FROM (
                            SELECT k, p, sum(x) AS s, count(*) AS z FROM (
                                SELECT k, unnest(v) AS x, unnest(range(1, 65)) AS p FROM ints JOIN a{r} USING (n)
                            ) GROUP BY k, p
                        ) GROUP BY k
                    ) m USING (k)
                )"""
            )
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, a.k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN ints USING (n) JOIN c{rounds} c ON c.k = a.k
    """


ORACLE_SQL["op12_centroids"] = _centroids()

# crc32 of the decimal id: a byte is marked by its value, each of its eight bits by -1
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
    lambda i: [ord(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

ORACLE_SQL["op13_prefix_trie"] = f"""
    WITH turns AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token, length(coalesce(text, '')) AS chars
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, {_CRC} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM turns)
    ), joined AS (
        SELECT c.conv_id, 0 AS part, t.pos, token, chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
        UNION ALL SELECT conv_id, 1, pos, token, chars FROM convs JOIN turns USING (conv_id) WHERE pos > h
    ), placed AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, token, chars, part, pos FROM joined
    ), paths AS MATERIALIZED (
        SELECT conv_id, depth, string_agg(token, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node, chars FROM placed
        UNION ALL SELECT conv_id, 0, '', 0 FROM convs
    ), sizes AS (
        SELECT conv_id, max(depth) AS size FROM paths GROUP BY conv_id
    ), nodes AS MATERIALIZED (
        SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(chars) AS chars FROM paths GROUP BY node
    ), linked AS MATERIALIZED (
        SELECT n.*, p.conv_id AS parent_conv_id, p.node AS parent FROM nodes n
        LEFT JOIN nodes p ON n.depth > 0 AND p.node = substr(n.node, 1, 64 * (n.depth - 1)::BIGINT)
    ), weighed AS (
        SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN (SELECT parent, count(*) AS n FROM linked GROUP BY parent) c ON c.parent = l.node
    ), totals AS (
        SELECT u.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.chars) AS saved_tokens
        FROM weighed v JOIN paths u ON u.conv_id = v.conv_id AND u.depth <= v.depth GROUP BY u.node
    ), stops AS (
        SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM paths JOIN sizes USING (conv_id) WHERE depth = size GROUP BY node
    )
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
           n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM weighed JOIN totals USING (node) LEFT JOIN stops USING (node)
"""
if pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = pipeline.ORACLE_SQL
