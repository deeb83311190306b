"""DuckDB SQL of the operators on shards and conversations, by plain ways of its own."""
from __future__ import annotations

#: The 256 remainders of a CRC-32, from its polynomial.
CRC_TABLE = """crc_step(i, k, c) AS (SELECT i, 0, i FROM range(256) t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crc_t FROM crc_step WHERE k = 8)"""


def crc32(hexed: str, n_bytes: str) -> str:
    """CRC-32 of bytes written as hexadecimal digits; needs crc_table beside it."""
    return f"""xor(4294967295, list_reduce(list_transform(range(0, {n_bytes}), lambda p: CAST('0x' || substr({hexed}, 2 * p + 1, 2) AS BIGINT)),
        lambda c, b: xor(crc_t[1 + (xor(c, b) & 255)], c >> 8), 4294967295))"""


def _wrap(value: str) -> str:
    return f"(({value}) % 18446744073709551616)"


def _turn(value: str, bits: int) -> str:
    return f"(({value}) * {1 << bits} % 18446744073709551616 + ({value}) // {1 << (64 - bits)})"


def _xxh64(name: str, source: str, value: str, seed: str, keep: str) -> str:
    """CTEs that add `name`, the XXH64 of an 8-byte number, to `source`."""
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    scrambled = _wrap(f"{_turn(_wrap(f'{value} * {p2}::UHUGEINT'), 31)} * {p1}::UHUGEINT")
    return f"""{name}_1 AS (SELECT {keep}, xor({_wrap(f'{seed} + {p5 + 8}::UHUGEINT')}, {scrambled}) AS x FROM {source}),
{name}_2 AS (SELECT {keep}, {_wrap(f"{_turn('x', 27)} * {p1}::UHUGEINT + {p4}::UHUGEINT")} AS x FROM {name}_1),
{name}_3 AS (SELECT {keep}, {_wrap(f'xor(x, x // {1 << 33}) * {p2}::UHUGEINT')} AS x FROM {name}_2),
{name}_4 AS (SELECT {keep}, {_wrap(f'xor(x, x // {1 << 29}) * {p3}::UHUGEINT')} AS x FROM {name}_3),
{name} AS (SELECT {keep}, xor(x, x // {1 << 32}) AS {name} FROM {name}_4)"""


SHARDS = f"""WITH RECURSIVE {CRC_TABLE},
texts AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS hx FROM documents),
sized AS (SELECT doc_id, CAST(n + 16 AS BIGINT) AS size, {crc32('hx', 'n')} AS text_crc32 FROM texts, crc_table),
keys AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS UHUGEINT) AS k FROM (SELECT DISTINCT doc_id FROM documents)),
{_xxh64('h', 'keys', 'k', '42', 'doc_id')},
tries AS (SELECT doc_id, h, CAST(s AS UHUGEINT) AS s FROM h, range(41) r(s)),
{_xxh64('g', 'tries', 's', 'h', 'doc_id, s')},
scores AS (SELECT doc_id, CAST(s AS INT) AS s, -ln((CAST(g // 2048 AS DOUBLE) + 0.5) / 9007199254740992.0) AS score FROM g),
won AS (SELECT doc_id, arg_min(s, (score, s)) FILTER (s < 40) AS shard, arg_min(s, (score, s)) AS grown_shard FROM scores GROUP BY doc_id)
SELECT sized.doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY sized.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM sized JOIN won ON sized.doc_id IS NOT DISTINCT FROM won.doc_id
"""


def _least(options: list[str]) -> str:
    return "list_min([" + ", ".join(options) + "])"


def _edge(letter: str, cost: str, value: str) -> str:
    return f"{{'c': {value}.c + {cost}, 's': '{letter}' || {value}.s}}"


def _repair_step(state: int) -> str:
    """The least over the edges that a row (i: initial, f: fault) gives a state; states as in v0 to v3."""
    then = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    kept = {0: "CASE i WHEN 's' THEN v1 WHEN 'u' THEN v2 END", 1: "CASE i WHEN 'u' THEN v2 END",
            2: "CASE i WHEN 'a' THEN v3 END", 3: "CASE i WHEN 'u' THEN v2 END"}[state]
    stays = "f NOT IN ('blank', 'duplicate')"
    more = "CASE WHEN f = 'truncated' THEN 5 ELSE 0 END"
    return _least([_edge("D", "2", f"v{state}"), f"CASE WHEN {stays} THEN {_edge('R', f'1 + {more}', f'v{then}')} ELSE none END",
                   f"CASE WHEN {stays} AND ({kept}) IS NOT NULL THEN {_edge('K', more, f'({kept})')} ELSE none END"])


_INSERTED = ", ".join([
    _least(["b0", _edge("I", "5", "b2"), _edge("I", "10", "{'c': b3.c, 's': 'I' || b3.s}")]) + " AS v0",
    _least(["b1", _edge("I", "5", "b2"), _edge("I", "10", "{'c': b3.c, 's': 'I' || b3.s}")]) + " AS v1",
    _least(["b2", _edge("I", "5", "b3")]) + " AS v2", _least(["b3", _edge("I", "5", "b2")]) + " AS v3"])

REPAIR = f"""WITH RECURSIVE {CRC_TABLE},
original AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (SELECT original.*, {crc32("hex(encode(k))", "strlen(k)")} % 20 AS kind FROM original, crc_table),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p FROM damaged),
judged AS (SELECT *, left(role, 1) AS i, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS following,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'none' END AS f FROM placed),
counted AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'blank') AS blank,
            count(*) FILTER (f = 'duplicate') AS duplicate, count(*) FILTER (f = 'truncated') AS truncated,
            count(*) FILTER (following IS NOT NULL AND i || following NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ends AS (SELECT {{'c': 0, 's': ''}} AS b0, {{'c': 1000000000, 's': ''}} AS b1, {{'c': 1000000000, 's': ''}} AS b2, {{'c': 0, 's': ''}} AS b3),
dp AS (SELECT conv_id, n AS p, {{'c': 1000000000, 's': ''}} AS none, {_INSERTED} FROM counted, ends
       UNION ALL SELECT conv_id, p, none, {_INSERTED} FROM (
           SELECT dp.conv_id, dp.p - 1 AS p, none, {", ".join(f"{_repair_step(q)} AS b{q}" for q in range(4))}
           FROM dp JOIN judged ON judged.conv_id IS NOT DISTINCT FROM dp.conv_id AND judged.p = dp.p)),
best AS (SELECT conv_id, v0.c AS cost, v0.s AS audit FROM dp WHERE p = 0),
letters AS (SELECT conv_id, q, substr(audit, q, 1) AS letter FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS q FROM best)),
used AS (SELECT *, CASE WHEN letter <> 'I' THEN count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY q) END AS p FROM letters),
lines AS (SELECT used.conv_id, q, letter, judged.role, judged.text,
          row_number() OVER w - 1 - max(CASE WHEN letter = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY used.conv_id) AS k
          FROM used LEFT JOIN judged ON judged.conv_id IS NOT DISTINCT FROM used.conv_id AND judged.p = used.p
          WHERE letter <> 'D' WINDOW w AS (PARTITION BY used.conv_id ORDER BY q)),
texts AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN k % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
          CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY q) AS whole FROM lines GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM o.conv_id
"""


TRIE = f"""WITH RECURSIVE {CRC_TABLE},
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS k FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {crc32("hex(encode(k))", "strlen(k)")} % 6 AS h FROM ids, crc_table),
lent AS (SELECT heads.conv_id, p, md5(role) || md5(text) AS t, length(text) AS size FROM heads JOIN turns ON turns.conv_id = base AND p <= h),
own AS (SELECT conv_id, 10 + p AS p, md5(role) || md5(text) AS t, length(text) AS size FROM turns JOIN heads USING (conv_id) WHERE p > h),
paths AS (SELECT heads.conv_id, coalesce(list(t ORDER BY p) FILTER (t IS NOT NULL), []) AS path, coalesce(list(size ORDER BY p) FILTER (t IS NOT NULL), []) AS sizes
          FROM heads LEFT JOIN (SELECT * FROM lent UNION ALL SELECT * FROM own) r ON r.conv_id = heads.conv_id GROUP BY heads.conv_id),
steps AS (SELECT conv_id, path, sizes, unnest(range(0, len(path) + 1)) AS d FROM paths),
nodes AS (SELECT path[1:d] AS pre, d, min(conv_id) AS conv_id, count(*) AS n, any_value(coalesce(sizes[d], 0)) AS size,
          coalesce(string_agg(CASE WHEN len(path) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends FROM steps GROUP BY ALL),
parents AS (SELECT c.pre, p.pre AS above, p.conv_id AS parent FROM nodes c JOIN nodes p ON p.d = c.d - 1 AND p.pre = c.pre[1:c.d - 1]),
kids AS (SELECT above AS pre, count(*) AS n_children FROM parents GROUP BY above),
below AS (SELECT nodes.pre[1:k] AS pre, sum(CASE WHEN kids.pre IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * size) AS saved
          FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM nodes) nodes LEFT JOIN kids ON kids.pre = nodes.pre GROUP BY 1)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM nodes LEFT JOIN parents ON parents.pre = nodes.pre LEFT JOIN kids ON kids.pre = nodes.pre JOIN below ON below.pre = nodes.pre
"""
