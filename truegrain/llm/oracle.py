"""SQL that computes the same as some of the queries, by plain joins over whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs of documents that share a shingle, counted; reachability by recursion.
COMPONENTS = rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
        FROM d),
    n AS (SELECT doc_id, len(g) AS n, md5(array_to_string(list_sort(g), chr(10))) AS class FROM s),
    e AS (SELECT doc_id, unnest(g) AS g FROM s),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (
        SELECT x, y, i.class <> j.class AS differs, j.class AS class
        FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y WHERE 100 * c >= 90 * (i.n + j.n - c)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
    SELECT n.doc_id, n.n::BIGINT AS n_shingles, m.component_id,
           coalesce(k.n_links, 0)::BIGINT AS n_links
    FROM n JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON m.x = n.doc_id
    LEFT JOIN (SELECT x, count(DISTINCT class) FILTER (differs) AS n_links FROM l GROUP BY x) k ON k.x = n.doc_id"""

#: Every window of 200 bytes, counted; windows that repeat united to runs; what lies between them.
REPEATS = """
    WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    w AS (SELECT doc_id, u.p, md5(array_slice(b, u.p, u.p + 199)) AS h FROM t, unnest(range(1, octet_length(b) - 198)) AS u(p)),
    r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
    i AS (
        SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS fresh FROM r)),
    g AS (SELECT doc_id, run, min(p) AS low, max(p) + 199 AS high FROM i GROUP BY doc_id, run),
    k AS (
        SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) + 1 AS a, low - 1 AS z FROM g
        UNION ALL
        SELECT t.doc_id, coalesce(max(g.high), 0) + 1, octet_length(any_value(t.b)) FROM t LEFT JOIN g USING (doc_id) GROUP BY t.doc_id),
    kept AS (
        SELECT doc_id, string_agg(CASE WHEN z < a THEN '' ELSE hex(array_slice(b, a, z)) END, '' ORDER BY a) AS x
        FROM k JOIN t USING (doc_id) GROUP BY doc_id)
    SELECT t.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(m.n_removed, 0)::BIGINT AS n_removed,
           coalesce(m.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(x)) AS kept_sha256
    FROM t JOIN kept USING (doc_id)
    LEFT JOIN (SELECT doc_id, sum(high - low + 1) AS n_removed, count(*) AS n_spans FROM g GROUP BY doc_id) m USING (doc_id)"""



#: Turn by turn: the cost to go before each, from the last to the first; then the edits, from the first.
#: States: 1 nothing yet, 2 after s, 3 after u, 4 after a; an insertion leads to ``inserted``.
REPAIR = r"""
    WITH RECURSIVE raw AS (
        SELECT coalesce(conv_id::VARCHAR, ' ') AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               c || ':' || coalesce(turn::VARCHAR, ' ') AS key
        FROM conversations),
    fated AS (
        SELECT *, xor(4294967295, list_reduce(
                   list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT)),
                   lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                                              lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS fate
        FROM raw),
    damaged AS (
        SELECT c, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
               CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM fated, unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
    ordered AS (
        SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth
        FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)),
    r AS (
        SELECT c, i, turn, role, text, left(role, 1) AS letter,
               CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
               fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more
        FROM ordered),
    n AS (SELECT c, count(*) AS n FROM r GROUP BY c),
    b AS (
        SELECT c, n + 1 AS i, [0, 10, 5, 0] AS v FROM n
        UNION ALL
        SELECT c, i, [least(c1, 5 + c3, 10 + c4), least(c2, 5 + c3, 10 + c4), least(c3, 5 + c4), least(c4, 5 + c3)]
        FROM (
            SELECT r.c, r.i, v, CASE WHEN gone THEN 1000000000 ELSE 1 + more END AS change,
                   CASE WHEN gone THEN 1000000000 ELSE more END AS keep,
                   least(2 + v[1], change + v[3], CASE letter WHEN 'u' THEN keep + v[3] WHEN 's' THEN keep + v[2] ELSE 2 + v[1] END) AS c1,
                   least(2 + v[2], change + v[3], CASE letter WHEN 'u' THEN keep + v[3] ELSE 2 + v[2] END) AS c2,
                   least(2 + v[3], change + v[4], CASE letter WHEN 'a' THEN keep + v[4] ELSE 2 + v[3] END) AS c3,
                   least(2 + v[4], change + v[3], CASE letter WHEN 'u' THEN keep + v[3] ELSE 2 + v[4] END) AS c4
            FROM b JOIN r ON r.c = b.c AND r.i = b.i - 1)),
    f AS (
        SELECT c, 1::BIGINT AS i, 1 AS s, '' AS audit, ''::VARCHAR AS lines FROM n
        UNION ALL
        SELECT c, CASE edit WHEN 'I' THEN i ELSE i + 1 END,
               CASE edit WHEN 'D' THEN s WHEN 'K' THEN kept ELSE inserted END, audit || edit,
               lines || CASE edit WHEN 'D' THEN '' ELSE chr(10) || CASE edit WHEN 'K' THEN role ELSE named END || ':'
                                      || CASE edit WHEN 'I' THEN '' ELSE text END END
        FROM (
            SELECT f.*, r.role, r.text, CASE s WHEN 3 THEN 4 ELSE 3 END AS inserted,
                   CASE s WHEN 3 THEN 'assistant' ELSE 'user' END AS named,
                   CASE WHEN gone THEN NULL WHEN letter = 'u' AND s <> 3 THEN 3 WHEN letter = 'a' AND s = 3 THEN 4
                        WHEN letter = 's' AND s = 1 THEN 2 END AS kept,
                   CASE WHEN r.i IS NULL THEN 'I'
                        WHEN 2 + later.v[s] = here.v[s] THEN 'D'
                        WHEN 5 + here.v[inserted] = here.v[s] THEN 'I'
                        WHEN more + later.v[kept] = here.v[s] THEN 'K' ELSE 'R' END AS edit
            FROM f JOIN b here ON here.c = f.c AND here.i = f.i
            LEFT JOIN r ON r.c = f.c AND r.i = f.i
            LEFT JOIN b later ON later.c = f.c AND later.i = f.i + 1
            WHERE r.i IS NOT NULL OR s IN (2, 3))),
    done AS (SELECT f.c, audit, lines FROM f JOIN n ON n.c = f.c AND f.i = n + 1 WHERE s IN (1, 4)),
    counted AS (
        SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
        FROM (SELECT *, lag(letter) OVER (PARTITION BY c ORDER BY i) AS before FROM r) GROUP BY c)
    SELECT raw.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.v[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
           sha256(coalesce(lines[2:], '')) AS repaired_sha256
    FROM (SELECT DISTINCT c, conv_id FROM raw) raw
    LEFT JOIN counted USING (c) LEFT JOIN done USING (c) LEFT JOIN b ON b.c = raw.c AND b.i = 1"""


def _vector_codes(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Every distance of every round; an entry of a codebook is a row for each position."""
    tables = [
        f"""
        k AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, label, len(embedding) // {parts} AS width,
                   list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS MATERIALIZED (
            SELECT r, (i - 1) // width AS part, (i - 1) % width AS place, v[i] AS v
            FROM (SELECT r, width, v, unnest(range(1, len(v) + 1)) AS i FROM k)),
        s AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM k QUALIFY entry < {entries}),
        b0 AS MATERIALIZED (SELECT part, entry, place, v FROM s JOIN x USING (r))"""
    ]
    for i in range(rounds + 1):
        tables.append(f"""
        a{i} AS MATERIALIZED (
            SELECT r, part, min(struct_pack(d := d, entry := entry)) AS m
            FROM (
                SELECT x.r, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v))::BIGINT AS d
                FROM x JOIN b{i} b USING (part, place) GROUP BY ALL)
            GROUP BY ALL)""")
        if i < rounds:
            tables.append(f"""
        b{i + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, b.place, coalesce(n.v, b.v) AS v
            FROM b{i} b LEFT JOIN (
                SELECT part, a.m.entry AS entry, place, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v
                FROM x JOIN a{i} a USING (r, part) GROUP BY ALL) n USING (part, entry, place))""")
    return f"""
    WITH {",".join(tables)},
    c AS (
        SELECT r, string_agg(lower(lpad(hex(m.entry), 2, '0')), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error
        FROM a{rounds} GROUP BY r)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) FROM b{rounds}) AS codebooks_sha256
    FROM c JOIN k USING (r)"""


ORACLE = {
    "op9_deep_shallow_repeats": REPEATS,
    "op10_prefix_tree_join": COMPONENTS,
    "op12_turn_repair": REPAIR,
    "op13_orchard_codes": _vector_codes(),
}
