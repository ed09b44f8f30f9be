"""SQL twins of the queries, in DuckDB's dialect, on whole tables."""

from __future__ import annotations

from declined.llm.common import LOWER, UPPER
from declined.llm.license_scan import KNOWN_LICENSES, SPELLINGS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lower_ascii(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


URL_FILTER = rf"""
    WITH parts AS (
        SELECT page_id, url,
               {lower_ascii("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
               list_sort(list_filter(
                   string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
                   lambda p: p <> '' AND NOT regexp_matches(p, '(?s)^(utm_.*|ref|fbclid|gclid)(=.*)?$')
               )) AS own
        FROM pages
    ),
    canonical AS (
        SELECT *, CASE WHEN contains(url, '://') THEN
               regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
               || CASE WHEN len(own) > 0 THEN '?' ELSE '' END || array_to_string(own, '&') END AS canonical
        FROM parts
    ),
    listed AS (
        SELECT canonical FROM canonical WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1
    ),
    judged AS (
        SELECT page_id, host, path,
               CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/')
                    THEN 'example.com/de/'
                    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')
                    THEN 'example.net/en/'
                    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
               END AS rule,
               canonical IS NOT NULL AND canonical IN (SELECT canonical FROM listed) AS listed
        FROM canonical
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
                WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
                WHEN listed THEN 'block' ELSE 'allow' END AS verdict,
           listed
    FROM judged
"""


def license_digest(text: str) -> str:
    t = (
        f"regexp_replace(lower({text}), '(?m)^[^\\p{{L}}\\p{{N}}©(\\n]*(copyright[ \\t]*(\\(c\\)|©|[0-9])"
        "|\\(c\\)[ \\t]*[0-9]|©)[^\\n]*$', ' ', 'g')"
    )
    t = f"regexp_replace({t}, '\\(c\\)|©', ' ', 'g')"
    t = f"trim(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    t = f"(' ' || replace({t}, ' ', '  ') || ' ')"
    for other, kept in SPELLINGS.items():
        t = f"replace({t}, ' {other.replace(' ', '  ')} ', ' {kept.replace(' ', '  ')} ')"
    return f"coalesce(sha256(trim(replace({t}, '  ', ' '))), '')"


NOTICES = ", ".join(
    f"({quoted(name)}, {quoted(text)})" for name, texts in KNOWN_LICENSES.items() for text in texts
)
LICENSE_SCAN = f"""
    WITH known AS (
        SELECT {license_digest("notice")} AS known_digest, min(license) AS license
        FROM (VALUES {NOTICES}) AS notices(license, notice) GROUP BY 1
    ),
    lines AS (
        SELECT DISTINCT doc_id, line
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    ),
    hits AS (
        SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
        FROM (SELECT doc_id, {license_digest("line")} AS digest FROM lines WHERE trim(line) <> '') AS digested
        JOIN known ON digest = known_digest GROUP BY doc_id
    ),
    whole AS (SELECT doc_id, {license_digest("text")} AS digest FROM documents)
    SELECT doc_id, digest, license, coalesce(n, 0) AS n_license_lines, names AS line_licenses
    FROM whole LEFT JOIN known ON digest = known_digest LEFT JOIN hits USING (doc_id)
"""

LINE_DEDUP = r"""
    WITH split AS (
        SELECT doc_id, source,
               regexp_replace(unnest(string_split(text, chr(10))),
                              '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
        FROM documents
    ),
    whole AS (
        SELECT DISTINCT doc_id, source, line FROM split WHERE line <> ''
    ),
    boilerplate AS (
        SELECT line, min(doc_id) AS first_id FROM whole GROUP BY line HAVING count(DISTINCT source) >= 8
    ),
    removed AS (
        SELECT doc_id, list(line) AS removed FROM whole JOIN boilerplate USING (line)
        WHERE doc_id <> first_id GROUP BY doc_id
    ),
    kept AS (
        SELECT doc_id, string_split(text, chr(10)) AS lines,
               list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(removed, []),
                   regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'))) AS rest
        FROM documents LEFT JOIN removed USING (doc_id)
    )
    SELECT doc_id, array_to_string(rest, chr(10)) AS text, len(lines) AS n_lines,
           len(lines) - len(rest) AS n_removed
    FROM kept
"""

DECONTAMINATION = rf"""
    WITH doc_words AS (
        SELECT doc_id, regexp_extract_all({lower_ascii("coalesce(text, '')")},
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    item_words AS (
        SELECT item_id, regexp_extract_all({lower_ascii("coalesce(text, '')")},
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ),
    grams AS (
        SELECT DISTINCT item_id, k, array_to_string(w[pos : pos + k - 1], ' ') AS gram
        FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos
              FROM item_words WHERE len(w) > 0)
    ),
    places AS (
        SELECT doc_id, k, pos, array_to_string(w[pos : pos + k - 1], ' ') AS gram
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos
              FROM doc_words, (SELECT DISTINCT k FROM grams))
    ),
    hits AS (SELECT doc_id, k, pos, item_id FROM places JOIN grams USING (k, gram)),
    hit_words AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM hits) GROUP BY doc_id
    ),
    hit_items AS (
        SELECT doc_id, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
        FROM hits GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

JACCARD_JOIN = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({lower_ascii("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[pos : pos + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM words WHERE len(w) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
    ),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)
    ),
    either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION
        SELECT reached.doc_id, either.b FROM reached JOIN either ON reached.other = either.a
    )
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

QUALITY_RULES = r"""
    WITH words AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ),
    windows AS (
        SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w[pos], w[pos + 1], w[pos + 2]) AS n
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS pos FROM words)
    ),
    repeated AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest(range(pos, pos + 3)) AS p FROM windows WHERE n > 1) GROUP BY doc_id
    ),
    counts AS (
        SELECT doc_id, len(w) AS n_words,
               CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) AS chars,
               len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
               len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(n, 0) AS n_repeat_words, len(regexp_extract_all(t, '\p{Lu}')) AS n_capitals
        FROM words LEFT JOIN repeated USING (doc_id)
    ),
    judged AS (
        SELECT *, coalesce(chars, 0) AS word_chars,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
        FROM counts
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR n_symbols * 10 > n_words * 3 OR n_dup_lines * 2 > n_lines
                OR word_chars < n_words * 2 OR word_chars > n_words * 15
                OR n_capitals * 2 > word_chars) AS kept
    FROM judged
"""


def crc32(text: str) -> str:
    """The unsigned checksum of an ASCII text, bit by bit."""
    return f"""xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)),
        lambda a, c: list_reduce(list_prepend(xor(a, c), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                                 lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))))"""


def merkle_levels(name: str, levels: int = 8) -> str:
    """Tables of a tree's nodes per level, from ``{name}_0``; per leaf its siblings, and what its tampered
    hash folds to, in ``{name}_way_{levels}``."""
    steps = [f"{name}_way_0 AS (SELECT key, place AS leaf_place, place, tampered AS f, '' AS beside FROM {name}_leaves)"]
    for k in range(levels):
        steps.append(f"""
    {name}_side_{k} AS (
        SELECT key, place, h, count(*) OVER (PARTITION BY key) AS n,
               coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
               coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM {name}_{k} WINDOW run AS (PARTITION BY key, place // 16 ORDER BY place)
    ),
    {name}_{k + 1} AS (
        SELECT key, place // 16 AS place, sha256(string_agg(h, '' ORDER BY place)) AS h
        FROM {name}_side_{k} WHERE n > 1 GROUP BY key, place // 16
        UNION ALL SELECT key, place, h FROM {name}_side_{k} WHERE n = 1
    ),
    {name}_way_{k + 1} AS (
        SELECT w.key, leaf_place, w.place // 16 AS place, beside || l || r AS beside,
               CASE WHEN n > 1 THEN sha256(l || f || r) ELSE f END AS f
        FROM {name}_way_{k} w JOIN {name}_side_{k} s ON w.key = s.key AND w.place = s.place
    )""")
    return ",\n    ".join(steps)


def merkle_field(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def merkle_leaf(text: str) -> str:
    fields = [*map(merkle_field, ("doc_id", "source", "lang", "n_chars")), merkle_field(text)]
    return f"sha256({' || '.join(fields)})"


MERKLE_MANIFEST = f"""
    WITH hashed AS (
        SELECT coalesce('=' || source, '') AS key, doc_id, {merkle_leaf("text")} AS h,
               {merkle_leaf(f"CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0"
                            f" THEN {lower_ascii('text')} ELSE text END")} AS tampered
        FROM documents
    ),
    a_leaves AS (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS place FROM hashed
    ),
    a_0 AS (SELECT key, place, h FROM a_leaves),
    {merkle_levels("a")},
    b_leaves AS (
        SELECT '' AS key, key AS source, row_number() OVER (ORDER BY key) - 1 AS place, h, h AS tampered FROM a_8
    ),
    b_0 AS (SELECT key, place, h FROM b_leaves),
    {merkle_levels("b")},
    -- What is folded below a source's root goes on from there, by the same siblings.
    c_leaves AS (
        SELECT a.key || chr(0) || a.leaf_place AS key, b.place, a.f AS tampered
        FROM a_way_8 a JOIN b_leaves b ON a.key = b.source
    ),
    c_way_0 AS (SELECT key, place, tampered AS f FROM c_leaves),
    {", ".join(f"""
    c_way_{k + 1} AS (
        SELECT w.key, w.place // 16 AS place, CASE WHEN n > 1 THEN sha256(l || f || r) ELSE f END AS f
        FROM c_way_{k} w JOIN b_side_{k} s ON w.place = s.place
    )""" for k in range(8))}
    SELECT a.doc_id, a.h AS leaf, b.h AS subroot, root.h AS root,
           sha256(w.beside || u.beside) AS proof_sha256, c.f AS folded_root, c.f = root.h AS verified
    FROM a_leaves a
    JOIN a_way_8 w ON w.key = a.key AND w.leaf_place = a.place
    JOIN b_leaves b ON b.source = a.key
    JOIN b_way_8 u ON u.leaf_place = b.place
    JOIN c_way_8 c ON c.key = a.key || chr(0) || a.place
    CROSS JOIN b_8 root
"""


SUFFIX_DEDUP = """
    WITH texts AS (
        SELECT row_number() OVER () AS id, doc_id, encode(coalesce(text, '')) AS t FROM documents
    ),
    starts AS (
        SELECT id, t, unnest(range(1, CAST(octet_length(t) AS BIGINT) - 398)) AS p FROM texts
    ),
    strings AS (SELECT id, p, md5(array_slice(t, p, p + 399)) AS h FROM starts),
    repeated AS (SELECT id, p FROM strings WHERE h IN (SELECT h FROM strings GROUP BY h HAVING count(*) > 1)),
    stretches AS (
        SELECT id, p, count(*) FILTER (fresh) OVER (PARTITION BY id ORDER BY p) AS stretch
        FROM (SELECT id, p, coalesce(p > lag(p) OVER (PARTITION BY id ORDER BY p) + 400, true) AS fresh FROM repeated)
    ),
    gone AS (
        SELECT id, min(p) AS first, max(p) + 399 AS last,
               lag(max(p) + 399, 1, 0) OVER (PARTITION BY id ORDER BY stretch) AS before
        FROM stretches GROUP BY id, stretch
    ),
    left_over AS (
        SELECT id, count(*) AS n_spans, sum(last - first + 1) AS n_removed,
               list_reduce(list(CASE WHEN first > before + 1 THEN array_slice(t, before + 1, first - 1)
                                     ELSE ''::BLOB END ORDER BY first), lambda a, b: a || b)
               || CASE WHEN max(last) < octet_length(any_value(t))
                       THEN array_slice(any_value(t), max(last) + 1, octet_length(any_value(t)))
                       ELSE ''::BLOB END AS kept
        FROM gone JOIN texts USING (id) GROUP BY id
    )
    SELECT doc_id, CAST(octet_length(t) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, t)) AS kept_sha256
    FROM texts LEFT JOIN left_over USING (id)
"""


def turn_edits() -> str:
    """Rows (fault, role, state, edits, cost, next state) for insertions before a row and its own edit.

    A state is the last turn's initial, or empty.
    """
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    found = []
    for fault in ("clean", "truncated", "gone"):
        for role in ("u", "a", "s", "?"):
            for state in ("", "s", "u", "a"):
                for n in range(3):
                    at = state
                    for _ in range(n):
                        at = "a" if at == "u" else "u"
                    found.append((fault, role, state, "I" * n + "D", 2 * n + 3, at))
                    late = int(fault == "truncated")
                    if fault != "gone":
                        found.append((fault, role, state, "I" * n + "R", 2 * n + 2 + late, "a" if at == "u" else "u"))
                        if role in follows[at]:
                            found.append((fault, role, state, "I" * n + "K", 2 * n + late, role))
    return ", ".join(map(str, found))


TURN_REPAIR = rf"""
    WITH RECURSIVE rows AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS d
        FROM conversations
    ),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM rows, range(2) AS copies(copy) WHERE d > 0 AND (copy = 0 OR d = 3)
    ),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS n FROM damaged
    ),
    judged AS (
        SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                       WHEN regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'clean' ELSE 'truncated' END AS fault,
               CASE WHEN role[1] IN ('u', 'a', 's') THEN role[1] ELSE '?' END AS initial,
               lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1] AS neighbours
        FROM numbered
    ),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows
        FROM judged GROUP BY conv_id
    ),
    edits (fault, initial, state, edit, cost, after) AS (VALUES {turn_edits()}),
    ways AS (
        SELECT conv_id, 0::BIGINT AS n, '' AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS way FROM counted
        UNION ALL
        SELECT w.conv_id, w.n + 1, e.after, min({{'cost': w.way.cost + e.cost, 'audit': w.way.audit || e.edit}})
        FROM ways w
        JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.n = w.n + 1
        JOIN edits e ON e.state = w.state AND e.initial = j.initial
             AND e.fault = CASE WHEN j.fault IN ('blank', 'duplicate') THEN 'gone' ELSE j.fault END
        GROUP BY w.conv_id, w.n, e.after
    ),
    ended AS (
        SELECT c.conv_id, min({{'cost': w.way.cost + 2 * length(e.edit), 'audit': w.way.audit || e.edit}}) AS way
        FROM counted c
        JOIN ways w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.n = c.rows
        JOIN (VALUES ('', ''), ('s', 'II'), ('u', 'I'), ('a', '')) e (state, edit) ON e.state = w.state
        GROUP BY c.conv_id
    ),
    letters AS (
        SELECT conv_id, i, substr(way.audit, i, 1) AS letter
        FROM (SELECT *, unnest(range(1, length(way.audit) + 1)) AS i FROM ended)
    ),
    placed AS (
        SELECT *, count(*) FILTER (letter <> 'I') OVER upto AS n, count(*) FILTER (letter <> 'D') OVER upto AS out
        FROM letters WINDOW upto AS (PARTITION BY conv_id ORDER BY i)
    ),
    left_over AS (
        SELECT p.conv_id, p.out, p.letter, j.role, CASE WHEN p.letter = 'I' THEN '' ELSE j.text END AS text,
               max(p.out = 1 AND p.letter = 'K' AND j.initial = 's') OVER (PARTITION BY p.conv_id) AS system
        FROM placed p
        JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.n = greatest(p.n, 1)
        WHERE p.letter <> 'D'
    ),
    hashed AS (
        SELECT conv_id, sha256(string_agg(
                   CASE WHEN letter = 'K' THEN role WHEN (out - CAST(system AS BIGINT)) % 2 = 1 THEN 'user'
                        ELSE 'assistant' END || ':' || text, chr(10) ORDER BY out)) AS sha
        FROM left_over GROUP BY conv_id
    ),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.way.cost, 0) AS cost,
           coalesce(e.way.audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
    FROM ids i
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM i.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": URL_FILTER,
        "op2_license_scan": LICENSE_SCAN,
        "op4_line_dedup": LINE_DEDUP,
        "op6_decontamination": DECONTAMINATION,
        "op7_jaccard_join": JACCARD_JOIN,
        "op9_quality_rules": QUALITY_RULES,
        "op11_suffix_dedup": SUFFIX_DEDUP,
        "op12_turn_repair": TURN_REPAIR,
        "op13_merkle_manifest": MERKLE_MANIFEST,
    }
