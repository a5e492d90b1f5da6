"""The text queries in SQL, written from their rules and not from their code."""

from __future__ import annotations

# The 8 shifts of a byte in a cyclic redundancy check, as a list to reduce over.
_CRC32 = """xor(list_reduce(
        list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT),
        lambda state, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7, 8],
            lambda s, k: CASE WHEN k = 0 THEN s ELSE xor(s >> 1, 3988292384 * (s & 1)) END, xor(state, byte)),
        4294967295::BIGINT), 4294967295)"""


def merkle_sql(levels: int = 12, top_levels: int = 6) -> str:
    """Trees of three, level by level: up to 3 ** ``levels`` documents a source, 3 ** ``top_levels`` sources."""

    def leaf(text: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    changed = f"CASE WHEN {_CRC32.format(text='doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    parts = [
        f"""leaves AS (
            SELECT doc_id, {leaf("text")} AS leaf, {leaf(changed)} AS claimed,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t, source FROM documents),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                   count(*) OVER (PARTITION BY t) AS n FROM leaves),
        a0 AS (SELECT t, i, n, leaf AS d FROM placed)"""
    ]

    def tree(a: str, levels: int) -> None:
        for k in range(levels):
            parts.append(f"""{a}{k + 1} AS (
                SELECT t, i // 3 AS i, (n + 2) // 3 AS n,
                       CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE min(d) END AS d
                FROM {a}{k} GROUP BY t, i // 3, n)""")
            parts.append(f"""{a}s{k} AS (
                SELECT x.t, x.i, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS b,
                       coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS e
                FROM {a}{k} x JOIN {a}{k} y ON x.t = y.t AND x.i // 3 = y.i // 3 WHERE x.n > 1 GROUP BY x.t, x.i)""")

    tree("a", levels)
    parts.append(f"b0 AS (SELECT 0 AS t, t AS i, count(*) OVER () AS n, d FROM a{levels})")
    tree("b", top_levels)
    parts.append("c0 AS (SELECT doc_id, leaf, t, i, claimed AS f, '' AS p FROM placed)")
    step = 0
    for a, own, index, count in (("a", "t", "i", levels), ("b", "0", "t", top_levels)):
        for k in range(count):
            parts.append(f"""c{step + 1} AS (
                SELECT doc_id, leaf, c.t, c.i, CASE WHEN s.t IS NULL THEN f ELSE sha256(b || f || e) END AS f,
                       p || coalesce(b || e, '') AS p
                FROM c{step} c LEFT JOIN {a}s{k} s ON s.t = c.{own} AND s.i = c.{index} // {3**k})""".replace("c.0", "0"))
            step += 1
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, u.d AS subroot, r.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = r.d AS verified
        FROM c{step} c JOIN a{levels} u ON u.t = c.t CROSS JOIN b{top_levels} r"""


COLLOCATIONS = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\n\x0b\x0c\r]')) AS piece
        FROM documents),
    words AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces),
    grams AS (
        SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
        FROM words, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
    totals AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 10),
    halves AS (
        SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS before, array_to_string(ws[cut + 1:], ' ') AS after
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
    cuts AS (
        SELECT h.lang, h.phrase, h.a, h.cut, l.a AS l, r.a AS r, (1000000 * h.a::HUGEINT * h.a) // (l.a::HUGEINT * r.a) AS score
        FROM halves h
        JOIN f l ON l.lang = h.lang AND l.phrase = h.before
        JOIN f r ON r.lang = h.lang AND r.phrase = h.after),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inner_pairs AS (
        SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase FROM candidates WHERE k = 3),
    covered AS (
        SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN inner_pairs b
        ON b.lang = s.lang AND b.phrase = s.phrase WHERE 100 * b.a >= 50 * s.a),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
        FROM lowest ANTI JOIN covered USING (lang, phrase))
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM placed JOIN totals USING (lang) WHERE rank <= 2000"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
    WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS ws FROM documents),
    items AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
    item_places AS (SELECT item_id, ws, least(len(ws), 13) AS k, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM items WHERE len(ws) > 0),
    windows AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS w FROM item_places),
    sizes AS (SELECT DISTINCT k FROM windows),
    doc_places AS (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, sizes WHERE len(ws) >= k),
    doc_windows AS (SELECT r, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w FROM doc_places),
    hits AS (SELECT r, k, i, item_id FROM doc_windows JOIN windows USING (k, w)),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, k, i FROM hits)) GROUP BY r),
    named AS (
        SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(ws) AS contaminated
    FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""

_TURN = "turn NULLS FIRST, role, text"


def _escaped_chars(text: str, marks: str) -> str:
    """Characters of a text in which each of the marks takes two."""
    return f"(length({text}) + " + " + ".join(f"length({text}) - length(replace({text}, '{m}', ''))" for m in marks) + ")"


CHAT = f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {_TURN})) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY {_TURN}) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length('### ') + {_escaped_chars("role", chr(92) + "<#:")} + length(': ') + {_escaped_chars("text", chr(92) + "<#")}
               + length('</turn>') + 1)::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id"""

SQL: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op3_chat": CHAT,
    "op12_merkle_manifest": merkle_sql(),
    "op13_collocations": COLLOCATIONS,
}
