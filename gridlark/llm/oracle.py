"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from .feistel import PRIME, ROUNDS, round_keys
from .queries import SHARDS

_SAYS = r"\### Assistant: </turn> ok"

_CHAT = rf"""
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{_SAYS}' UNION ALL SELECT -7, 1, 'assistant', '{_SAYS}'
), sized AS (
    SELECT *, len(text) + (len(text) - len(replace(text, chr(92), '')))
        - 4 * ((len(text) - len(replace(text, '<turn>', ''))) // 6)
        - 5 * ((len(text) - len(replace(text, '</turn>', ''))) // 7) AS inner_
    FROM rows_
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(inner_ + len(role) + 15) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_RULES = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
    SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
), again AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 8)) AS k) GROUP BY r),
lines AS (
    SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS dup
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters,
        coalesce(lines.n, 0) AS n_lines, len(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims
    FROM words LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines
        OR 100 * n_symbols > 5 * word_chars OR 100 * n_stutters > 30 * n_words OR 100 * n_exclaims > 60 * n_words
        OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM m
"""

_ARCHIVE = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


def _shards() -> str:
    keys = " UNION ALL ".join(f"SELECT {i} AS i, {a} AS a, {b} AS b" for i, (a, b) in enumerate(round_keys(0)))
    line = f"((r * a + b) % {PRIME})"
    return f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS x FROM documents
), size_ AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS m FROM docs),
keys_ AS ({keys}),
walk AS (
    SELECT x, x // m AS l, x % m AS r, 0 AS i FROM docs CROSS JOIN size_
    UNION ALL
    SELECT x, CASE WHEN walk.i = {ROUNDS} THEN l ELSE r END, CASE WHEN walk.i = {ROUNDS} THEN r
        ELSE (l + ({line} * {line}) % {PRIME} % m) % m END, CASE WHEN walk.i = {ROUNDS} THEN 0 ELSE walk.i + 1 END
    FROM walk CROSS JOIN size_ LEFT JOIN keys_ ON keys_.i = walk.i WHERE walk.i < {ROUNDS} OR l * m + r >= n
), placed AS (SELECT x, l * m + r AS p FROM walk CROSS JOIN size_ WHERE i = {ROUNDS} AND l * m + r < n),
byte_rule AS (
    SELECT list(c ORDER BY b) AS rule FROM (
        SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b)
    )
), sums AS (
    SELECT x, CASE WHEN t = '' THEN 0 ELSE xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
        lambda c, v: xor(c >> 8, rule[CAST(xor(c, v) & 255 AS INT) + 1]))) END AS crc
    FROM docs, byte_rule
)
SELECT doc_id, CAST(octet_length(encode(t)) + 8 AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law,
    CAST(p % {SHARDS} AS INT) AS shard, CAST(p // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM docs JOIN placed USING (x) JOIN sums USING (x)
"""

_AUDIT = r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM docs),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
    SELECT doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, (
        CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS f
    FROM words LEFT JOIN marks USING (doc_id)
),
filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS o FROM filters a, filters b, filters c, filters d, filters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT o AS filter_order, CAST(k AS INT) AS step, o[k] AS own FROM orders, (SELECT unnest(range(1, 6)) AS k)),
-- where a set of failures is removed by an order (6: nowhere)
fate AS (
    SELECT f, o, list_min(list_append(list_transform(string_split(f, ''), lambda x: CASE WHEN x = '' THEN 6 ELSE instr(o, x) END), 6)) AS place
    FROM (SELECT DISTINCT f FROM failed), orders
),
counted AS (
    SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY part, f
),
report AS (
    SELECT part, filter_order, step, own,
        sum(n) FILTER (place > step) AS kept, sum(n) FILTER (place = step) AS removed,
        sum(n) FILTER (contains(f, own) AND place < step) AS redundant, sum(n) FILTER (f = own) AS unique_fails,
        sum(good) FILTER (place = step) AS good_lost, sum(toxic) FILTER (place = step) AS toxic_lost
    FROM counted JOIN fate USING (f) JOIN steps ON o = filter_order GROUP BY part, filter_order, step, own
),
shares AS (SELECT part, own, sum(removed) AS shapley FROM report GROUP BY part, own)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
    CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(coalesce(shapley, 0) AS BIGINT) AS shapley
FROM report JOIN shares USING (part, own)
"""

def _merkle() -> str:
    fields = ("doc_id", "source", "lang", "n_chars", "{text}")
    value = [f"CAST({c} AS VARCHAR)" for c in fields]
    row = " || ".join(f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')" for v in value)

    def levels(name: str, leaves: str) -> str:
        return f"""{name} AS (
    SELECT 0 AS lvl, p, i, n, h FROM {leaves}
    UNION ALL
    SELECT lvl + 1, p, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY lvl, p, i // 3, n
), {name}_beside AS (
    SELECT a.lvl, a.p, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
    FROM {name} a JOIN {name} b ON a.lvl = b.lvl AND a.p = b.p AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.lvl, a.p, a.i
)"""

    def path(name: str, start: str) -> str:
        return f"""{name}_path AS (
    SELECT r, 0 AS lvl, p, i, n, h, proof, 0 AS done FROM {start}
    UNION ALL
    SELECT x.r, x.lvl + 1, x.p, x.i // 3, (x.n + 2) // 3, sha256(b.l || x.h || b.r), x.proof || b.l || b.r, 0
    FROM {name}_path x JOIN {name}_beside b ON x.lvl = b.lvl AND x.p = b.p AND x.i = b.i WHERE x.n > 1
)"""

    return f"""
WITH RECURSIVE byte_rule AS (
    SELECT list(c ORDER BY b) AS rule FROM (
        SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b)
    )
), docs AS (
    SELECT documents.*, row_number() OVER () AS r, xor(1, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, v: xor(c >> 8, rule[CAST(xor(c, v) & 255 AS INT) + 1])) & 1) AS odd
    FROM documents, byte_rule
), leaf AS (
    SELECT r, doc_id, coalesce('=' || source, '') AS p, sha256({row.format(text="text")}) AS leaf,
        sha256({row.format(text="(CASE WHEN odd = 0 THEN replace(text, chr(10), '') ELSE text END)")}) AS other
    FROM docs
), placed AS (
    SELECT *, leaf AS h, row_number() OVER (PARTITION BY p ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY p) AS n FROM leaf
), {levels("sub", "placed")},
top_leaves AS (
    SELECT p AS name, '' AS p, row_number() OVER (ORDER BY p) - 1 AS i, count(*) OVER () AS n, h FROM sub WHERE n = 1
), {levels("top", "top_leaves")},
own AS (SELECT r, p, i, n, other AS h, '' AS proof FROM placed),
{path("sub", "own")},
half AS (
    SELECT x.r, t.p, t.i, t.n, x.h, x.proof FROM sub_path x JOIN top_leaves t ON x.p = t.name WHERE x.n = 1
), {path("top", "half")}
SELECT doc_id, leaf, t.h AS subroot, root.h AS root, sha256(x.proof) AS proof_sha256, x.h AS folded_root, x.h = root.h AS verified
FROM top_path x JOIN placed USING (r) JOIN top_leaves t ON placed.p = t.name JOIN (SELECT h FROM top WHERE n = 1) root ON x.n = 1
"""


ORACLE = {
    "op3_reply_trees": _CHAT,
    "op5_rule_ledger": _RULES,
    "op7_content_archive": _ARCHIVE,
    "op9_feistel_shards": _shards(),
    "op12_filter_audit": _AUDIT,
    "op13_merkle_bitmaps": _merkle(),
}
