"""SQL equivalents (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

#: CTE ``crc``: the byte table of crc32, by its rule (eight shifts with the reversed polynomial).
CRC_TABLE = """crc AS MATERIALIZED (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, bit:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc_table
)"""


def crc32(text: str) -> str:
    """The crc32 of a text's UTF-8 bytes, where CTE ``crc`` is joined."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    return (
        f"xor(list_reduce(range(octet_length(encode({text}))), lambda c, i: "
        f"xor(c >> 8, crc_table[(xor(c, {byte}) & 255) + 1]), 4294967295), 4294967295)"
    )


def ascii_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def merkle_manifest() -> str:
    said = lambda v: f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(said, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def levels(name: str, base: str, key: str) -> str:
        return f"""{name}(key, lvl, i, h, n) AS (
            {base}
            UNION ALL
            SELECT key, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 15) // 16)
            FROM {name} WHERE n > 1 GROUP BY key, lvl, i // 16
        )"""

    def steps(nodes: str, first: int) -> str:
        return f"""SELECT r, {first} + b.lvl AS step,
                coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < p.i >> (4 * b.lvl)), '') AS lft,
                coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > p.i >> (4 * b.lvl)), '') AS rgt
            FROM {"placed" if nodes == "below" else "placed_sources"} p JOIN {nodes} b
                ON b.key = p.key AND b.n > 1 AND b.i // 16 = p.i >> (4 * b.lvl + 4)
            GROUP BY r, b.lvl"""

    return f"""
    WITH RECURSIVE {CRC_TABLE}, hashed AS (
        SELECT doc_id, coalesce('=' || source, '') AS key, {leaf("text")} AS leaf,
            CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(ascii_lower("text"))} ELSE {leaf("text")} END AS claimed
        FROM documents, crc
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            row_number() OVER (ORDER BY key, doc_id NULLS FIRST, leaf) AS r
        FROM hashed
    ), {levels("below", "SELECT key, 0, i, leaf, count(*) OVER (PARTITION BY key) FROM placed", "key")},
    tops AS (
        SELECT key AS source_key, '' AS key, h AS subroot, row_number() OVER (ORDER BY key) - 1 AS i FROM below WHERE n = 1
    ), placed_sources AS (
        SELECT r, '' AS key, t.i FROM placed p JOIN tops t ON t.source_key = p.key
    ), {levels("above", "SELECT key, 0, i, subroot, count(*) OVER () FROM tops", "key")},
    steps AS (
        SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS step, lft, rgt
        FROM ({steps("below", 0)} UNION ALL {steps("above", 100)})
    ), folds(r, step, h) AS (
        SELECT r, 0, claimed FROM placed
        UNION ALL
        SELECT f.r, s.step, sha256(s.lft || f.h || s.rgt) FROM folds f JOIN steps s ON s.r = f.r AND s.step = f.step + 1
    ), proofs AS (
        SELECT r, sha256(string_agg(lft || rgt, '' ORDER BY step)) AS proof FROM steps GROUP BY r
    ), folded AS (SELECT r, arg_max(h, step) AS folded_root FROM folds GROUP BY r)
    SELECT p.doc_id, p.leaf, t.subroot, a.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.folded_root,
        f.folded_root = a.h AS verified
    FROM placed p JOIN tops t ON t.source_key = p.key JOIN above a ON a.n = 1
        JOIN folded f ON f.r = p.r LEFT JOIN proofs q ON q.r = p.r
    """


def embedding_dedup() -> str:
    return """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.93
    ), reach(a, b) AS (
        SELECT vec_id, vec_id FROM embeddings
        UNION
        SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
    ), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept
    FROM component c
    """


def spelling_variants() -> str:
    return f"""
    WITH RECURSIVE {CRC_TABLE}, runs AS (
        SELECT doc_id, run, count(*) AS times FROM (
            SELECT doc_id, unnest(regexp_extract_all({ascii_lower("text")}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
        ) WHERE length(run) >= 6 GROUP BY doc_id, run
    ), drawn AS (
        SELECT run, times, {crc32("doc_id || ':' || run")} AS h FROM runs, crc
    ), words AS (
        SELECT word, sum(times)::BIGINT AS n FROM (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
            FROM drawn
        ) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
    ), holes AS (
        SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
        FROM words, unnest(range(1, length(word) + 1)) AS r(i)
    ), near AS (
        SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
        UNION
        SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.head || h.tail
        UNION
        SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.head || h.tail
    ), best AS (
        SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word
    ), formed AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN other END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
        FROM words w LEFT JOIN best b ON b.word = w.word
    ), walk(word, place) AS (
        SELECT word, word FROM words
        UNION ALL
        SELECT k.word, f.form FROM walk k JOIN formed f ON f.word = k.place WHERE f.form IS NOT NULL
    ), ends AS (
        SELECT k.word, k.place AS root FROM walk k JOIN formed f ON f.word = k.place WHERE f.form IS NULL
    )
    SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN ends e ON e.word = f.word
    """
