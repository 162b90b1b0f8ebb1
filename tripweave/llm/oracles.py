"""The SQL that queries of this folder must equal, where SQL can state it."""

# Letter and digit runs in small letters, and the windows of up to five of them.
_WORDS = "list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '')"
_GRAMS = "list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))"

# Words apart at white space, A-Z as a-z, and the windows of three of them, or all where there are fewer.
_PLAIN = "list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

_BLANK = "[ \\t\\n\\x0B\\f\\r]+"
_UNQUOTED = f"regexp_replace(regexp_replace(coalesce(text, ''), '(?m)^[ \\t]*>[^\\r\\n]*(\\r\\n|\\r|\\n|$)', '', 'g'), '^{_BLANK}|{_BLANK}$', '', 'g')"

# Terms of a text, and the CRC-32 of the decimal digits of c, bit by bit.
_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_BITS = "flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
_CRC32 = f"xor(list_reduce(list_concat([4294967295::BIGINT], {_BITS}), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"


def _normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


ORACLES: dict[str, str] = {
    "op5_quote_links": f"""
        WITH RECURSIVE named AS (SELECT row_number() OVER () AS m, * FROM (SELECT DISTINCT conv_id, turn, text FROM conversations)),
        split AS (SELECT m, conv_id, turn, regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\r|\\n') AS parts FROM named),
        bodies AS (SELECT m, conv_id, turn, generate_subscripts(parts, 1) - 1 AS line, unnest(parts) AS body FROM split),
        lines AS (
          SELECT m, conv_id, turn, line, {_normal('body')} AS words,
                 len(regexp_replace(regexp_extract(body, '^[ \\t]*(>[ \\t]*)+'), '[^>]', '', 'g')) AS level
          FROM bodies
        ),
        opened AS (
          SELECT *, CAST(level IS DISTINCT FROM lag(level) OVER o OR words = '' OR coalesce(lag(words) OVER o, '') = '' AS INTEGER) AS opens
          FROM lines WINDOW o AS (PARTITION BY m ORDER BY line)
        ),
        runs AS (SELECT *, sum(opens) OVER (PARTITION BY m ORDER BY line) AS run FROM opened),
        passages AS (
          SELECT * FROM (
            SELECT m, conv_id, turn, level, min(line) AS first, string_agg(words, ' ' ORDER BY line) AS words
            FROM runs WHERE words <> '' GROUP BY m, conv_id, turn, level, run
            UNION ALL SELECT m, conv_id, turn, 0, 0, {_normal(_UNQUOTED)} FROM named
          ) WHERE len(string_split(words, ' ')) >= 3
        ),
        quoted AS (SELECT * FROM passages WHERE level > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL),
        own AS (SELECT DISTINCT words, conv_id, turn FROM passages WHERE level = 0 AND conv_id IS NOT NULL AND turn IS NOT NULL),
        earliest AS (SELECT words, min({{'c': conv_id, 't': turn}}) AS e FROM own GROUP BY words),
        here AS (
          SELECT q.m, q.level, q.first, q.words, max(o.turn) AS t
          FROM quoted q JOIN own o ON o.words = q.words AND o.conv_id = q.conv_id AND o.turn < q.turn GROUP BY ALL
        ),
        origins AS (
          SELECT q.m, q.level, q.first, q.conv_id, q.turn,
                 CASE WHEN h.t IS NOT NULL THEN {{'c': q.conv_id, 't': h.t}} WHEN e.e.c < q.conv_id THEN e.e END AS origin
          FROM quoted q LEFT JOIN here h ON (h.m, h.level, h.first, h.words) = (q.m, q.level, q.first, q.words)
          LEFT JOIN earliest e ON e.words = q.words
        ),
        answers AS (
          SELECT m, conv_id, turn, min({{'l': level, 'f': first, 'o': origin}}).o AS parent, count(*) AS n_linked
          FROM origins WHERE origin IS NOT NULL GROUP BY m, conv_id, turn
        ),
        links AS (SELECT conv_id, turn, min(parent) AS parent FROM answers GROUP BY conv_id, turn),
        up AS (
          SELECT conv_id, turn, parent, 1::BIGINT AS depth FROM links
          UNION ALL SELECT u.conv_id, u.turn, l.parent, u.depth + 1 FROM up u JOIN links l ON l.conv_id = u.parent.c AND l.turn = u.parent.t
        ),
        threads AS (SELECT conv_id, turn, max(depth) AS depth, arg_max(parent, depth) AS top FROM up GROUP BY conv_id, turn),
        counted AS (SELECT m, count(*) AS n_quotes FROM passages WHERE level > 0 GROUP BY m)
        SELECT c.conv_id, c.turn, c.role, {_UNQUOTED.replace('text', 'c.text')} AS text,
               coalesce(k.n_quotes, 0) AS n_quotes, coalesce(a.n_linked, 0) AS n_linked, a.parent.c AS parent_conv, a.parent.t AS parent_turn,
               coalesce(t.top.c, c.conv_id) AS thread_conv, coalesce(t.top.t, c.turn) AS thread_turn, coalesce(t.depth, 0) AS depth
        FROM conversations c
        JOIN named n ON n.conv_id IS NOT DISTINCT FROM c.conv_id AND n.turn IS NOT DISTINCT FROM c.turn AND n.text IS NOT DISTINCT FROM c.text
        LEFT JOIN counted k ON k.m = n.m LEFT JOIN answers a ON a.m = n.m
        LEFT JOIN threads t ON t.conv_id = c.conv_id AND t.turn = c.turn""",
    "op6_decontaminate": f"""
        WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        sized AS (SELECT item_id, w, least(5, len(w)) AS width FROM item_words WHERE len(w) > 0),
        items AS (SELECT DISTINCT item_id, width, list_sort(list_distinct({_GRAMS})) AS grams FROM sized),
        doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        doc_widths AS (SELECT r, doc_id, w, width FROM doc_words, (SELECT DISTINCT width FROM items) WHERE len(w) >= width),
        doc_grams AS (SELECT DISTINCT r, doc_id, width, unnest({_GRAMS}) AS gram FROM doc_widths),
        item_grams AS (SELECT item_id, width, grams, unnest(grams) AS gram FROM items)
        SELECT doc_id, item_id, len(grams) AS n_shingles, count(*) AS n_shared
        FROM doc_grams JOIN item_grams USING (width, gram)
        GROUP BY r, doc_id, item_id, grams HAVING 100 * count(*) >= 80 * len(grams)""",
    "op10_ngram_join": f"""
        WITH RECURSIVE doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN} AS w FROM documents),
        sized AS (SELECT r, doc_id, w, least(3, len(w)) AS width FROM doc_words),
        sets AS (SELECT r, doc_id, CASE WHEN width > 0 THEN list_distinct({_GRAMS}) ELSE [] END AS grams FROM sized),
        grams AS (SELECT r, len(grams) AS n, hash(unnest(grams)) AS gram FROM sets),
        shared AS (
          SELECT a.r AS a, b.r AS b, a.n AS na, b.n AS nb, count(*) AS common
          FROM grams a JOIN grams b ON a.gram = b.gram AND a.r <> b.r GROUP BY ALL
        ),
        links AS (SELECT a, b FROM shared WHERE 100 * common >= 90 * (na + nb - common)),
        reached AS (SELECT r, doc_id AS seen FROM sets UNION SELECT l.b, x.seen FROM reached x JOIN links l ON l.a = x.r)
        SELECT doc_id, len(grams) AS n_shingles, (SELECT min(seen) FROM reached x WHERE x.r = s.r) AS component_id FROM sets s""",
    "op12_prefix_trie": f"""
        WITH conv AS (
          SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        sized AS (SELECT c, turns, {_CRC32} % 9 AS h FROM conv),
        rebuilt AS (
          SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS s FROM sized a LEFT JOIN conv b ON b.c = a.c - a.c % 5
        ),
        members AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt),
        nodes AS (
          SELECT d, s[1:d] AS k, min(c) AS conv_id, count(*) AS n, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d) AS ends
          FROM members GROUP BY ALL
        ),
        kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
        full_nodes AS (
          SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n - 1) * strlen(n.k[n.d].t) END AS saved
          FROM nodes n LEFT JOIN kids USING (d, k)
        ),
        up AS (SELECT k, saved, n_children, unnest(range(0, d + 1)) AS e FROM full_nodes),
        sums AS (SELECT e AS d, k[1:e] AS k, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM up GROUP BY ALL)
        SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children, CAST(leaves AS BIGINT) AS n_leaves,
               CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
        FROM full_nodes n JOIN sums s USING (d, k) LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]
    """,
    "op13_treap_search": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
        cells AS (SELECT r, doc_id, t, count(*) AS tf FROM (SELECT r, doc_id, unnest(terms) AS t FROM docs) GROUP BY ALL),
        sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM cells GROUP BY r),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM sizes),
        weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM cells, total GROUP BY t, docs),
        items AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark),
        asked AS (SELECT DISTINCT i, item_id, t FROM (SELECT i, item_id, unnest(terms) AS t FROM items)),
        impacts AS (SELECT c.*, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // len)) AS impact FROM cells c JOIN sizes USING (r), total),
        scores AS (
          SELECT i, item_id, r, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
          FROM asked JOIN weights USING (t) JOIN impacts USING (t) GROUP BY ALL HAVING sum(w * impact) > 0
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS p FROM scores)
        SELECT item_id, CAST(p AS INTEGER) AS rank, doc_id, score FROM ranked WHERE p <= 10
    """,
}
