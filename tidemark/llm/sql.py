"""SQL counterparts of the text queries, for DuckDB over whole tables.

They share fixed values with the operators (known licence texts, equal spellings) and no other code:
patterns are those of the contracts, places come from running sums over the texts between matches.
"""

from __future__ import annotations

from tidemark.llm.license_scan import EQUAL, known_rows

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _places(kind: str, pattern: str) -> str:
    """(doc, kind, m, s, e): all matches of a pattern and their places."""
    return f"""
  SELECT doc, '{kind}' AS kind, m, s, s + length(m) AS e FROM (
    SELECT doc, ms[n] AS m,
      list_sum(list_transform(gs[1:n], lambda g: length(g)))::BIGINT
        + coalesce(list_sum(list_transform(ms[1:n-1], lambda x: length(x))), 0)::BIGINT AS s
    FROM (SELECT doc, regexp_extract_all(text, '{pattern}') AS ms,
            string_split_regex(text, '{pattern}') AS gs FROM d), unnest(range(1, len(ms) + 1)) AS t(n))"""


_NAME = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
_HEAD = f"""(?:{_NAME})["'']?\\x20*[:=]\\x20*["'']?"""

_PIECES = "(?i)(?:example|sample|dummy|placeholder|changeme|your[_-]|0123456789|abcdefghij|1234567890|x{6,}|0{8,}|[*]{3,})"

SECRETS = rf"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_places('assign', _HEAD + '[A-Za-z0-9+/_.=-]+')}
  UNION ALL {_places('access', 'AKIA[A-Z0-9]+')}
  UNION ALL {_places('hex', '[0-9a-f]+')}),
base AS (
  SELECT doc, kind, s, e, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END AS num FROM found
  WHERE CASE kind WHEN 'assign' THEN length(regexp_replace(m, '^{_HEAD}', '')) >= 6
        WHEN 'access' THEN length(m) >= 20 ELSE length(m) >= 24 END),
runs AS ({_places('entropy', '[A-Za-z0-9+/_=-]+')}),
cands AS (
  SELECT doc, m, s, CASE WHEN regexp_full_match(m, '[0-9a-fA-F]+') THEN 3.0
      WHEN regexp_full_match(m, '[A-Za-z0-9]+') THEN 3.6 ELSE 3.8 END AS least
  FROM runs WHERE length(m) >= 20 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')
    AND NOT regexp_full_match(m, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}')),
cut AS (SELECT doc, s, least, string_split_regex(m, '{_PIECES}') AS parts, regexp_extract_all(m, '{_PIECES}') AS pieces FROM cands),
parts AS (
  SELECT doc, parts[n] AS m, least, s + coalesce(list_sum(list_transform(parts[1:n-1], lambda x: length(x))), 0)::BIGINT
    + coalesce(list_sum(list_transform(pieces[1:n-1], lambda x: length(x))), 0)::BIGINT AS s
  FROM cut, unnest(range(1, len(parts) + 1)) AS t(n) WHERE length(parts[n]) >= 20),
wins AS (SELECT doc, s, least, o, unnest(string_split(substr(m, o + 1, 20), '')) AS ch FROM parts, unnest(range(0, length(m) - 19)) AS t(o)),
counts AS (SELECT doc, s, least, o, ch, count(*) AS c FROM wins GROUP BY ALL),
ent AS (SELECT doc, s, least, o, -sum(c / 20.0 * log2(c / 20.0)) AS h FROM counts GROUP BY ALL),
rnd AS (SELECT doc, 'entropy' AS kind, s + min(o) AS s, s + max(o) + 20 AS e, 3 AS num FROM ent WHERE round(h, 9) >= least GROUP BY doc, ent.s),
both_ AS (SELECT doc, kind, s, e, num FROM base UNION ALL SELECT doc, kind, s, e, num FROM rnd)
SELECT doc_id,
  (SELECT count(*) FROM base b WHERE b.doc = d.doc AND kind = 'assign') AS n_assign,
  (SELECT count(*) FROM base b WHERE b.doc = d.doc AND kind = 'access') AS n_access,
  (SELECT count(*) FROM base b WHERE b.doc = d.doc AND kind = 'hex') AS n_hex,
  sha256(coalesce((SELECT string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, num) FROM base b WHERE b.doc = d.doc), '')) AS base_sha256,
  coalesce((SELECT string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, num) FROM both_ b WHERE b.doc = d.doc), '') AS spans
FROM d"""

_CONTEXT = {
    "email": "mail|contact|write|kontakt|courriel|correo",
    "ip": "ip|server|host|address|adresse|login",
    "card": "card|credit|visa|mastercard|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|fax|mobile|telefon|appel|llam",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|taxpayer",
}

# Registered lengths of account numbers.
_LENGTHS = (
    "15 NO,16 BE,18 DK FI FK FO GL NL SD,19 MK SI,20 AT BA EE KZ LT LU MN XK,21 CH HR LI LV,22 BG BH CR DE GB GE IE ME RS VA,"
    "23 AE GI IL IQ OM SO TL,24 AD CZ ES MD PK RO SA SE SK TN VG,25 LY PT ST,26 IS TR,27 BI DJ FR GR IT MC MR SM,"
    "28 AL AZ BY CY DO GT HN HU LB NI PL SV,29 BR EG PS QA UA,30 JO KW MU YE,31 MT SC,32 LC,33 RU"
)
_BY_LENGTH = [(int(x.split()[0]), x.split()[1:]) for x in _LENGTHS.split(",")]
_CODES = "|".join(c for _, codes in _BY_LENGTH for c in codes)
_SIZED = "|".join(
    f"(?:{'|'.join(codes)})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, codes in _BY_LENGTH
)

PII = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
heads AS (SELECT doc, i - 1 AS s, substr(text, i, 60) AS rest FROM d, unnest(range(1, length(text) - 13)) AS t(i)
  WHERE regexp_matches(text, '[A-Z]{{2}}[0-9]{{2}}') AND regexp_full_match(substr(text, i, 4), '[A-Z]{{2}}[0-9]{{2}}')
    AND (i = 1 OR NOT regexp_full_match(substr(text, i - 1, 1), '[A-Za-z0-9]'))),
numbers AS (
  SELECT doc, s, m, row_number() OVER (PARTITION BY doc ORDER BY s) AS n FROM (
    SELECT doc, s, CASE WHEN regexp_matches(rest, '^(?:{_CODES})') THEN regexp_extract(rest, '^({_SIZED})(?:[^A-Za-z0-9]|$)', 1)
      ELSE regexp_extract(string_split_regex(rest, ' (?:{_CODES})[0-9]{{2}}')[1], '^([A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?:[^A-Za-z0-9]|$)', 1) END AS m
    FROM heads) WHERE m <> ''),
-- One after the other: a number that begins within the one before is none.
apart AS (
  SELECT doc, s, m, n, true AS own, s + length(m) AS e FROM numbers WHERE n = 1
  UNION ALL SELECT x.doc, x.s, x.m, x.n, x.s >= a.e, CASE WHEN x.s >= a.e THEN x.s + length(x.m) ELSE a.e END FROM apart a JOIN numbers x ON x.doc = a.doc AND x.n = a.n + 1),
ibans AS (SELECT doc, s, m FROM apart WHERE own),
found AS ({_places('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+')}
  UNION ALL {_places('ip', '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+')}
  UNION ALL {_places('card', '[0-9](?:[ -]?[0-9])+')}
  UNION ALL {_places('phone', '[+][0-9][ ().0-9-]+[0-9]')}
  UNION ALL SELECT doc, 'iban', m, s, s + length(m) FROM ibans
  UNION ALL {_places('ssn', '[0-9]{3}-[0-9]{2}-[0-9]{4}')}),
seen AS (SELECT found.*, regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS code, substr(d.text, s, 1) AS prior,
    substr(d.text, e + 1, 1) AS next, lower(substr(d.text, greatest(s - 39, 1), least(s, 40)::BIGINT) || ' ' || substr(d.text, e + 1, 40)) AS near
  FROM found JOIN d USING (doc)),
good AS (
  SELECT doc, kind, s, e, CASE kind WHEN 'email' THEN 0 WHEN 'ip' THEN 1 WHEN 'card' THEN 2 WHEN 'phone' THEN 3 WHEN 'iban' THEN 4 ELSE 5 END AS num
  FROM seen WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_max(list_transform(string_split(m, '.'), lambda p: coalesce(try_cast(p AS HUGEINT), 256))) <= 255
    WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
        CASE WHEN i % 2 = 1 THEN reverse(digits)[i]::INT ELSE (reverse(digits)[i]::INT * 2) - CASE WHEN reverse(digits)[i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
    WHEN 'iban' THEN list_reduce(list_prepend(0::HUGEINT, list_transform(string_split(code[5:] || code[1:4], ''), lambda c:
        (CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)::HUGEINT)), lambda a, v: (CASE WHEN v < 10 THEN a * 10 ELSE a * 100 END + v) % 97) = 1
    ELSE NOT regexp_matches(prior, '[0-9-]') AND NOT regexp_matches(next, '[0-9-]') AND digits[1:3] NOT IN ('000', '666') AND digits[1:1] <> '9'
      AND digits[4:5] <> '00' AND digits[6:9] <> '0000' AND regexp_matches(near, '{_CONTEXT['ssn']}') END)
SELECT doc_id,
  (SELECT count(*) FROM good b WHERE b.doc = d.doc AND kind = 'email') AS n_email,
  (SELECT count(*) FROM good b WHERE b.doc = d.doc AND kind = 'ip') AS n_ip,
  (SELECT count(*) FROM good b WHERE b.doc = d.doc AND kind = 'card') AS n_card,
  (SELECT count(*) FROM good b WHERE b.doc = d.doc AND kind = 'phone') AS n_phone,
  sha256(coalesce((SELECT string_agg(kind || ':' || s || ':' || e, ',' ORDER BY num, s) FROM good b WHERE b.doc = d.doc AND num < 4), '')) AS base_sha256,
  coalesce((SELECT string_agg(kind || ':' || s || ':' || e, ',' ORDER BY num, s) FROM good b WHERE b.doc = d.doc), '') AS spans
FROM d"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(10, len(ws)) AS size, array_to_string(ws[o + 1:o + least(10, len(ws))], ' ') AS gram
  FROM b, unnest(range(0, greatest(len(ws) - 9, 1))) AS t(o) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM grams),
wins AS (SELECT doc, o, size, array_to_string(ws[o + 1:o + size], ' ') AS gram FROM d, sizes, unnest(range(0, len(ws) - size + 1)) AS t(o)),
hits AS (SELECT doc, o, size, item FROM wins JOIN grams USING (size, gram)),
words AS (SELECT doc, count(DISTINCT w) AS n_hit FROM hits, unnest(range(o, o + size)) AS t(w) GROUP BY doc),
items AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc, item FROM hits) GROUP BY doc)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc) LEFT JOIN items USING (doc)"""


_LEAD = r"^[\x20\x09\x0D*#/;-]*"
_OF_LAW = (
    "Notices?|Licen[cs]es?|Holders?|Owners?|Laws?|Acts?|Statements?|Rights?|Treat(?:y|ies)|Interests?|Protection|Infringement|Information|"
    "Permissions?|Status|Office|Conventions?|Grants?|Terms|And|Or|In|On|Of|To|Is"
)


def _spelt(form: str, pairs: list[tuple[str, str]]) -> str:
    for other, usual in pairs:
        form = f"replace({form}, '{other}', '{usual}')"
    return form


def _line_forms(texts: str, ids: str) -> str:
    """(ids, part, ln, form): canonical lines of a table of texts, numbered, with the number of their paragraph."""
    stated = (
        rf"regexp_matches(low, '{_LEAD}(?:copyright[\x20\x09]*(?:\(c\)|©|&copy;|[:,]?[\x20\x09]*(?:[0-9]{{4}}|by[\x20\x09]|[<\[{{]|year|yyyy|name of|holder name))"
        rf"|\(c\)[\x20\x09]*(?:copyright|[0-9]{{4}}|by[\x20\x09]|[<\[{{])|©|&copy;|all rights reserved)')"
        rf" OR (regexp_matches(line, '{_LEAD}(?:Copyright|\(C\))[\x20\x09]+[A-Z][^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[a-z]')"
        rf" AND NOT regexp_matches(line, '{_LEAD}(?:Copyright|\(C\))[\x20\x09]+(?:{_OF_LAW})\b'))"
    )
    marks = r"[\x00-\x2F\x3A-\x60\x7B-\x7F“”‘’–—•©]+"
    return rf"""
  SELECT {ids}, part, row_number() OVER (PARTITION BY {ids} ORDER BY n) - 1 AS ln, form FROM (
    SELECT {ids}, n, part, {_spelt(f"trim(regexp_replace(low, '{marks}', ' ', 'g'))", EQUAL)} AS form FROM (
      SELECT {ids}, n, line, translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        sum(CASE WHEN regexp_full_match(line, '[\x20\x09\x0B-\x0D*#/;-]*') THEN 1 ELSE 0 END) OVER (PARTITION BY {ids} ORDER BY n) AS part
      FROM (SELECT {ids}, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM {texts}))
    WHERE NOT ({stated})) WHERE form <> ''"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN = ",\n".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known_rows())
_TWO_WORDS = [e for e in EQUAL if " " in e[0]]
_WHOLE = _spelt("string_agg(form, ' ' ORDER BY ln)", _TWO_WORDS)

LICENSES = rf"""
WITH k AS (SELECT row_number() OVER () AS t, license, text FROM (VALUES {_KNOWN}) AS v(license, text)),
kl AS ({_line_forms('k', 't')}),
digests AS (SELECT sha256(form) AS digest, min(license) AS license FROM (SELECT t, {_WHOLE} AS form FROM kl GROUP BY t) JOIN k USING (t) GROUP BY 1),
notices AS (
  SELECT digest, min(license) AS license FROM (
    SELECT sha256(form) AS digest, license FROM (SELECT t, part, {_WHOLE} AS form FROM kl GROUP BY t, part) JOIN k USING (t) WHERE len(string_split(form, ' ')) >= 25)
  GROUP BY digest HAVING count(DISTINCT license) = 1),
units AS (SELECT digest, min(license) AS license FROM (SELECT * FROM digests UNION ALL SELECT * FROM notices) GROUP BY digest),
d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
dl AS ({_line_forms('d', 'doc')}),
spots AS (
  SELECT doc, ln, 1 AS size, sha256(form) AS digest FROM dl
  UNION ALL SELECT doc, min(ln), count(*), sha256({_WHOLE}) FROM dl GROUP BY doc, part HAVING count(*) > 1),
found AS (
  SELECT doc, count(DISTINCT place) AS n_lines, array_to_string(list_sort(list_distinct(list(license))), ',') AS line_licenses
  FROM (SELECT doc, license, unnest(range(ln, ln + size)) AS place FROM spots JOIN units USING (digest)) GROUP BY doc),
whole AS (SELECT doc, sha256({_WHOLE}) AS digest FROM dl GROUP BY doc)
SELECT doc_id, digest, license, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(line_licenses, '') AS line_licenses
FROM d LEFT JOIN whole USING (doc) LEFT JOIN digests USING (digest) LEFT JOIN found USING (doc)"""

SUBSTRINGS = r"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
wins AS (SELECT doc, doc_id, o, array_to_string(ws[o + 1:o + 20], ' ') AS win FROM d, unnest(range(0, len(ws) - 19)) AS t(o)),
later AS (SELECT doc, o FROM (SELECT doc, o, rank() OVER (PARTITION BY win ORDER BY doc_id, o) AS r FROM wins) WHERE r > 1),
gone AS (SELECT DISTINCT doc, w FROM later, unnest(range(o, o + 20)) AS t(w)),
lost AS (SELECT doc, count(*) AS n, list(w) AS at FROM gone GROUP BY doc),
kept AS (SELECT doc, string_agg(ws[w + 1], ' ' ORDER BY w) AS text FROM (SELECT doc, ws, unnest(range(0, len(ws))) AS w FROM d) WHERE (doc, w) NOT IN (SELECT (doc, w) FROM gone) GROUP BY doc)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc) LEFT JOIN kept USING (doc)"""

AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter, '[' || filter_order[1:step] || ']' AS so_far,
    '[' || filter_order[1:step - 1] || '-]' AS earlier FROM orders, unnest(range(1, 6)) AS t(step)),
met AS (SELECT s.*, c.*, regexp_matches(fails, so_far) AS gone, contains(fails, letter) AS own, regexp_matches(fails, earlier) AS before FROM steps s, cells c),
counted AS (
  SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (own AND NOT before), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (own AND before), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (own AND NOT before), 0)::BIGINT AS good_lost, coalesce(sum(bad) FILTER (own AND NOT before), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted"""
