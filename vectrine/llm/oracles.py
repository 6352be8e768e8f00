"""DuckDB SQL for the rows of those operators that SQL can express."""

from __future__ import annotations

from .quality_rules import DUPLICATE_LIMITS, LEAST_WORDS, LINE_CHARS_LIMIT, LINE_LIMIT, REPEAT_PERCENT, REPEAT_WINDOW, SYMBOL_LIMIT, TOP_LIMITS

# --- personal data -----------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
CONTEXT = {
    "email": "e-?mail|mail|contact|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|adresse",
    "card": "card|visa|master|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|anruf",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "ssn": r"\bssn\b|social security",
}
SCORE = {"email": (0.9, 0.1), "ip": (0.7, 0.2), "card": (0.8, 0.2), "phone": (0.7, 0.2), "iban": (0.9, 0.1), "ssn": (0.3, 0.5)}
DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
TURNED = "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4)"
VALID = {
    "email": "TRUE",
    "ip": "len(list_filter(string_split(m, '.'), lambda x: try_cast(x AS HUGEINT) > 255 OR try_cast(x AS HUGEINT) IS NULL)) = 0",
    "card": f"length({DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda i: "
    f"CASE WHEN i % 2 = 1 THEN reverse({DIGITS})[i]::INT ELSE reverse({DIGITS})[i]::INT * 2 - "
    f"CASE WHEN reverse({DIGITS})[i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0",
    "phone": f"length({DIGITS}) BETWEEN 9 AND 15",
    "iban": "length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND NOT regexp_matches(around, '^[A-Za-z0-9]|[A-Za-z0-9]$') AND "
    f"list_reduce(list_prepend(0, list_transform(string_split(array_to_string(list_transform(string_split({TURNED}, ''), "
    "lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN (ord(c) - 55)::VARCHAR ELSE c END), ''), ''), lambda d: d::INT)), "
    "lambda a, d: (a * 10 + d) % 97) = 1",
    "ssn": "NOT regexp_matches(m, '^(?:000|666|9)|-00-|-0000$') AND NOT regexp_matches(around, '^[A-Za-z0-9-]|[A-Za-z0-9-]$')",
}


def _kind(rank: int, kind: str) -> str:
    score, lift = SCORE[kind]
    return f"""
    {kind}_m AS (
      SELECT doc_id, t, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS m, unnest(gaps[1:len(found)]) AS g
      FROM (SELECT doc_id, t, regexp_extract_all(t, '{PLAIN[kind]}') AS found, string_split_regex(t, '{PLAIN[kind]}') AS gaps FROM d)),
    {kind}_p AS (
      SELECT doc_id, t, m, (sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS stop FROM {kind}_m),
    {kind}_s AS (
      SELECT doc_id, {rank} AS rank, '{kind}' AS kind, stop - length(m) AS start, stop,
        round({score} + CASE WHEN regexp_matches(lower(substr(t, greatest(stop - length(m) - 39, 1), least(40, stop - length(m)))), '{CONTEXT[kind]}')
              THEN {lift} ELSE 0 END, 2) AS score
      FROM (SELECT *, CASE WHEN stop > length(m) THEN substr(t, stop - length(m), 1) ELSE ' ' END
                      || ' ' || CASE WHEN stop < length(t) THEN substr(t, stop + 1, 1) ELSE ' ' END AS around FROM {kind}_p)
      WHERE {VALID[kind]})"""


OP1 = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),"
    + ",".join(_kind(i, k) for i, k in enumerate(PLAIN))
    + ", spans AS ("
    + " UNION ALL ".join(f"SELECT * FROM {k}_s" for k in PLAIN)
    + """ ),
    told AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans, max(score)::DOUBLE AS top_score
      FROM spans WHERE score >= 0.5 OR rank < 4 GROUP BY doc_id)
    SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(top_score, 0.0::DOUBLE) AS top_score
    FROM d LEFT JOIN told USING (doc_id)"""
)

# --- quality rules -----------------------------------------------------------------

LENGTHS = [*TOP_LIMITS, *DUPLICATE_LIMITS]


def _grams(n: int) -> str:
    """Per document the share of its words' characters inside repeated (or the most frequent) n-grams."""
    chosen = (
        f"(SELECT doc_id, arg_max(g, [c, chars, -first]) AS g FROM g{n} WHERE c > 1 GROUP BY doc_id)"
        if n in TOP_LIMITS
        else f"(SELECT doc_id, g FROM g{n} WHERE c > 1)"
    )
    return f"""
    p{n} AS (SELECT doc_id, i, list_slice(w, i, i + {n - 1}) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n})),
    g{n} AS (SELECT doc_id, g, count(*) AS c, min(i) AS first, list_sum(list_transform(g, lambda x: length(x))) AS chars FROM p{n} GROUP BY doc_id, g),
    k{n} AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM p{n} SEMI JOIN {chosen} USING (doc_id, g)),
    s{n} AS (SELECT doc_id, sum(length(w[i])) AS covered FROM k{n} JOIN d USING (doc_id) GROUP BY doc_id)"""


RULES = (
    [(f"top_{n}", f"x{n} > {v}") for n, v in TOP_LIMITS.items()]
    + [(f"duplicate_{n}", f"x{n} > {v}") for n, v in DUPLICATE_LIMITS.items()]
    + [("lines", f"line_share > {LINE_LIMIT}"), ("line_chars", f"char_share > {LINE_CHARS_LIMIT}"), ("symbols", f"n_symbols > {SYMBOL_LIMIT} * n_words")]
)
BLANK = r"[^\x20\x09-\x0D]"
OP2 = (
    rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{BLANK}+') AS w FROM documents),
    lines AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again
      FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(t, chr(10)) AS l FROM d))
      WHERE regexp_matches(line, '{BLANK}')),
    told AS (SELECT doc_id, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (again) / count(*) AS line_share,
      coalesce(sum(length(line)) FILTER (again), 0) / sum(length(line)) AS char_share FROM lines GROUP BY doc_id),"""
    + ",".join(_grams(n) for n in LENGTHS)
    + f""",
    r3 AS (SELECT DISTINCT doc_id, unnest(range(i, i + {REPEAT_WINDOW})) AS i FROM p3 SEMI JOIN (SELECT doc_id, g FROM g3 WHERE c > 1) USING (doc_id, g)),
    rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM r3 GROUP BY doc_id),
    base AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
    shares AS (SELECT base.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(line_share, 0) AS line_share, coalesce(char_share, 0) AS char_share,
      coalesce(n_repeat_words, 0) AS n_repeat_words, """
    + ", ".join(f"coalesce(s{n}.covered / word_chars, 0)::DOUBLE AS x{n}" for n in LENGTHS)
    + " FROM base LEFT JOIN told USING (doc_id) LEFT JOIN rep USING (doc_id) "
    + " ".join(f"LEFT JOIN s{n} USING (doc_id)" for n in LENGTHS)
    + f"""),
    judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
      array_to_string(list_filter(["""
    + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in RULES)
    + """], lambda x: x IS NOT NULL), ',') AS broken FROM shares)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken = '' AS kept, broken,
      greatest("""
    + ", ".join(f"x{n}" for n in DUPLICATE_LIMITS)
    + ") AS duplicate_share FROM judged"
)

# --- benchmark windows -------------------------------------------------------------

WORDS = (
    "regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP6 = f"""
    WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
    b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {WORDS.format('text')} AS w FROM benchmark) WHERE len(w) > 0),
    units AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
    lens AS (SELECT DISTINCT n FROM units),
    grams AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
      FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
    hits AS (SELECT doc_id, n, i, item_id FROM grams JOIN units USING (n, g)),
    words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
      sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


OP11 = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t)),
f AS (SELECT words, min(doc_id) AS first FROM g GROUP BY words HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, list(DISTINCT p) AS places FROM
           (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (words) WHERE doc_id > first) GROUP BY doc_id),
x AS (SELECT doc_id, w, i, NOT list_contains(coalesce(places, []), i) AS kept FROM (SELECT t.doc_id, w, places, unnest(range(1, len(w) + 1)) AS i FROM t LEFT JOIN gone USING (doc_id))),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (NOT kept) AS n_removed,
        sha256(coalesce(string_agg(w[i], ' ' ORDER BY i) FILTER (kept), '')) AS kept_sha256 FROM x GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)
"""


# CRC-32 of the decimal digits, bit by bit.
SQL_CRC32 = """
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), range(8)),
        lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)"""

OP13 = rf"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns FROM conversations GROUP BY conv_id),
taken AS (SELECT conv_id, turns, conv_id - conv_id % 20 AS base, {SQL_CRC32} % 4 AS h FROM own),
full_turns AS (
  SELECT t.conv_id, list_concat(coalesce(b.turns[1:t.h], []), t.turns[t.h + 1:]) AS s FROM taken t LEFT JOIN own b ON t.base = b.conv_id),
prefixes AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM full_turns),
nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, list(conv_id ORDER BY conv_id) FILTER (len(s) = depth) AS ends
  FROM (SELECT *, s[1:depth] AS p FROM prefixes) GROUP BY p, depth),
priced AS (
  SELECT *, (n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(p[depth].text, '[^\x20\x09-\x0D]+')) END AS saved FROM nodes),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
marked AS (SELECT priced.*, coalesce(kids.n, 0) AS n_children FROM priced LEFT JOIN kids USING (p)),
under AS (
  SELECT u.p, sum(v.saved)::BIGINT AS saved_tokens, (count(*) FILTER (v.n_children = 0))::BIGINT AS n_leaves
  FROM marked u JOIN marked v ON v.depth >= u.depth AND v.p[1:u.depth] = u.p GROUP BY u.p)
SELECT m.conv_id, m.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens,
  sha256(coalesce(array_to_string(m.ends, ','), '')) AS ends_sha256
FROM marked m JOIN under USING (p) LEFT JOIN nodes parent ON m.depth > 0 AND parent.p = m.p[1:m.depth - 1]
"""
