"""DuckDB SQL of the registered queries that SQL can express on whole tables.

The others have none: DuckDB has no crc32, XXH64, tokenizer or model fit. They are tested against brute force, exact round trips and held-out rows in ``tests/llm``.
"""

import math

from . import secret_scan
from .filter_audit import CAPITAL_SHARE, DISTINCT_SHARE, LEAST_WORDS
from .quality_rules import BASE_RULES, DISTINCT_BASE, MARKS, RULES, STOP_WORDS, SYMBOLS, any_of
from .url_filter import BLOCKED_WORDS, RULES as URL_RULES
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

GAP = r"[\x20\x09-\x0D]+"


def _count(characters):
    return f"length(text) - length(translate(text, '{characters}', ''))"


def _quality_rules():
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
    WITH d AS (
      SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (
      SELECT *, [x FOR x IN string_split_regex(text, '{GAP}') IF x <> ''] AS words,
             [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
      FROM d),
    places AS (SELECT rid, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
    windows AS (
      SELECT rid, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS gram
      FROM places WINDOW o AS (PARTITION BY rid ORDER BY i)),
    repeated AS (
      SELECT rid, i FROM windows WHERE gram IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
    hit AS (
      SELECT rid, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
    m AS (
      SELECT doc_id, len(words) AS n_words, length(list_aggregate(words, 'string_agg', '')) AS chars,
             {_count(SYMBOLS)} AS n_symbols, {_count(MARKS)} AS n_marks,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             coalesce(hit.n, 0) AS n_repeat_words,
             len([x FOR x IN words IF lower(x) IN ({stop})]) AS n_stop_words,
             len(list_distinct(words)) AS n_distinct_words, least(len(words), {DISTINCT_BASE}) AS least_of_words
      FROM w LEFT JOIN hit USING (rid)),
    s AS (SELECT *, coalesce(chars, 0) AS word_chars FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           ({any_of(BASE_RULES)}) AS base_failed, NOT ({any_of((*BASE_RULES, *RULES))}) AS kept
    FROM s"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(source, key):
    """One row per word: the row's own number, its id, the word and its place."""
    return rf"""
      SELECT rid, {key}, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n
      FROM (SELECT row_number() OVER () AS rid, {key},
                   regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM {source})"""


def _grams(source, key, size):
    tail = "".join(f" || ' ' || lead(word, {k}) OVER o" for k in range(1, size))
    return f"""SELECT rid, {key}, i, n, {size} AS size, word{tail} AS gram FROM {source}
      WINDOW o AS (PARTITION BY rid ORDER BY i)"""


def _decontamination():
    """Windows of every length up to ten, looked up in the document's windows of that length."""
    item = " UNION ALL ".join(
        f"SELECT item_id, size, gram FROM ({_grams('item_words', 'item_id', k)}) WHERE gram IS NOT NULL AND {'n >= 10' if k == 10 else f'n = {k}'}"
        for k in range(1, 11)
    )
    # A length that no item has costs one empty join.
    doc = " UNION ALL ".join(
        f"""SELECT rid, i, size, gram FROM ({_grams('doc_words', 'doc_id', k)})
        WHERE gram IN (SELECT gram FROM item_windows WHERE size = {k})"""
        for k in range(1, 11)
    )
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    doc_words AS ({_words('documents', 'doc_id')}),
    item_words AS ({_words('benchmark', 'item_id')}),
    item_windows AS (SELECT DISTINCT item_id, size, gram FROM ({item})),
    found AS ({doc}),
    hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM found) GROUP BY rid),
    items AS (
      SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT rid, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM found JOIN item_windows USING (size, gram)) GROUP BY rid)
    SELECT doc_id,
           len(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}')) AS n_words,
           coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""


def _warc_bundles():
    """Base 32 of a SHA-1: each five hex digits are four letters."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = " || ".join(
        f"substr('{alphabet}', CAST((CAST('0x' || substr(hex, {5 * k + 1}, 5) AS BIGINT) >> {shift}) & 31 AS BIGINT) + 1, 1)"
        for k in range(8)
        for shift in (15, 10, 5, 0)
    )
    return f"""
    SELECT page_id, strlen(payload) AS payload_bytes, {letters} AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> top THEN top END AS refers_to
    FROM (SELECT page_id, payload, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS top
          FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))"""


def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _either(word):
    """Either case of each letter, without the folding of other alphabets."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _matches(source, column, pattern, keep="true"):
    """All matches of a pattern with their places: the parts between them give the lengths."""
    p = _text(pattern)
    return f"""SELECT * EXCLUDE (found, gaps, nth), found[nth] AS m,
        CAST(list_sum([length(g) FOR g IN gaps[1:nth]]) + coalesce(list_sum([length(f) FOR f IN found[1:nth - 1]]), 0)
             AS BIGINT) AS place
      FROM (SELECT *, unnest(range(1, len(found) + 1)) AS nth FROM (
        SELECT *, regexp_extract_all({column}, {p}) AS found, string_split_regex({column}, {p}) AS gaps FROM {source}))
      WHERE {keep.replace("PATTERN", p)}"""


def _secret_scan():
    names = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    base = {
        "assign": (assign, f"length(regexp_extract(found[nth], PATTERN, 2)) >= {secret_scan.ASSIGN_LEAST}"),
        "access": (r"AKIA[A-Z0-9]+", f"length(found[nth]) >= {secret_scan.ACCESS_LEAST}"),
        "hex": (secret_scan.LONG_HEX.pattern, "true"),
    }
    known = " UNION ALL ".join(
        f"SELECT rid, '{kind}' AS kind, {n} AS o, place AS start, place + length(m) AS stop FROM ({_matches('d', 'text', p, keep)})"
        for n, (kind, (p, keep)) in enumerate(base.items())
    )
    known_words = [
        " OR ".join(f"regexp_full_match(m, {_text(p.pattern)})" for p in patterns)
        for patterns in (secret_scan.ALLOWED, secret_scan.PLAIN)
    ]
    before = f"substr(text, greatest(place - {secret_scan.BEFORE_CHARS}, 0) + 1, least(place, {secret_scan.BEFORE_CHARS}))"
    added = " UNION ALL ".join(_class(n, *c) for n, c in enumerate(secret_scan.CLASSES, len(base)))
    line = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o)"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    known AS ({known}),
    candidates AS (
      SELECT rid, m AS c, place AS c_start, {known_words[0]} AS allowed, {known_words[1]} AS plain
      FROM ({_matches('d', 'text', secret_scan.CANDIDATE.pattern)})
      WHERE NOT regexp_matches({before}, {_text(secret_scan.ALLOWED_BEFORE.pattern)})),
    added AS (
      SELECT * FROM ({added}) a WHERE NOT EXISTS (
        SELECT 1 FROM known k WHERE k.rid = a.rid AND k.start <= a.start AND a.stop <= k.stop)),
    base AS (
      SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, {line} AS spans FROM known GROUP BY rid),
    whole AS (
      SELECT rid, count(*) AS n_spans, {line} AS spans FROM (SELECT * FROM known UNION ALL SELECT * FROM added) GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base.spans, '')) AS base_sha256, coalesce(whole.spans, '') AS spans, coalesce(n_spans, 0) AS n_spans
    FROM d LEFT JOIN base USING (rid) LEFT JOIN whole USING (rid)"""


def _class(number, kind, characters, width, bits, letters, digits, changes, patterns):
    """Every window of a class's runs by its own counts, then neighbours merged."""
    source = f"(SELECT * FROM candidates WHERE NOT {'allowed' if patterns is secret_scan.ALLOWED else 'plain'})"
    kinds = f"translate(w, '{UPPER}{LOWER}0123456789', '{'A' * 26}{'a' * 26}{'0' * 10}')"
    changed = " + ".join(f"length({kinds}) - length(replace({kinds}, '{pair}', ' '))" for pair in ("aA", "a0", "A0", "0a", "0A"))
    units = [secret_scan.entropy_units(c) for c in range(width + 1)]
    most = round(width * (math.log2(width) - bits) * secret_scan.SCALE)
    run = characters.pattern.removesuffix("+") + f"{{{width},}}"
    return f"""
      SELECT rid, '{kind}' AS kind, {number} AS o, c_start + place + min(i) AS start, c_start + place + max(i) + {width} AS stop
      FROM (
        SELECT *, sum(opens) OVER (PARTITION BY rid, c_start, place ORDER BY i) AS part FROM (
          SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY rid, c_start, place ORDER BY i) + {width} THEN 0 ELSE 1 END AS opens
          FROM (
            SELECT *, substr(m, i + 1, {width}) AS w FROM (
              SELECT *, unnest(range(length(m) - {width} + 1)) AS i FROM ({_matches(source, 'c', run)})))
          WHERE list_sum([{units}[length(w) - length(replace(w, x, '')) + 1] FOR x IN list_distinct(string_split(w, ''))]) <= {most}
            AND length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= {letters}
            AND length(regexp_replace(w, '[^0-9]', '', 'g')) >= {digits}
            AND {changed} >= {changes}))
      GROUP BY rid, c_start, place, part"""


def _url_filters():
    """Every rule tried on every url by its host and path, the longest that fits first."""
    tries = []
    for verdict, rule in sorted(URL_RULES, key=lambda r: (-len(r[1]), -len(r[1].split("/")[0]), r[0] != "block")):
        host, path = rule.split("/", 1)[0], rule[len(rule.split("/", 1)[0]) :]
        tries.append(
            f"WHEN (host = {_text(host)} OR ends_with(host, {_text('.' + host)})) AND starts_with(path, {_text(path)}) "
            f"THEN {{'rule': {_text(rule)}, 'verdict': {_text(verdict)}}}"
        )
    listed = ", ".join(_text(w) for w in sorted(BLOCKED_WORDS, key=lambda w: (len(w), w), reverse=True))
    return rf"""
    SELECT page_id, host, path, hit.rule AS rule,
           coalesce(hit.verdict, CASE WHEN word IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
           CASE WHEN hit IS NULL THEN word END AS blocked_word
    FROM (SELECT *, CASE {' '.join(tries)} END AS hit,
                 [x FOR x IN [{listed}] IF list_contains(string_split_regex(host, '[^a-z0-9]+'), x)][1] AS word
          FROM (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
                       coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages))"""


def _vector_codes():
    """Every part against every entry, round by round."""
    width = "(SELECT len(v) FROM vectors ORDER BY vec_id NULLS LAST, v LIMIT 1)"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
    assigned{r} AS (
      SELECT rid, part, min(far) AS far, arg_min(entry, (far, entry)) AS entry, any_value(p) AS p
      FROM (SELECT rid, part, entry, parts.p AS p,
                   list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(parts.p, books{r}.p)]) AS far
            FROM parts JOIN books{r} USING (part)) GROUP BY rid, part)""")
        if r < ROUNDS:
            steps.append(f"""
    means{r} AS (
      SELECT part, entry, list(m ORDER BY i) AS m FROM (
        SELECT part, entry, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m
        FROM (SELECT part, entry, unnest(p) AS x, unnest(range(len(p))) AS i FROM assigned{r}) GROUP BY part, entry, i)
      GROUP BY part, entry),
    books{r + 1} AS (SELECT part, entry, coalesce(m, p) AS p FROM books{r} LEFT JOIN means{r} USING (part, entry))""")
    last = f"assigned{ROUNDS}"
    return rf"""
    WITH vectors AS (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
             [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
      FROM embeddings
      WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    parts AS (
      SELECT rid, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS p
      FROM vectors, (SELECT unnest(range({PARTS})) AS part) WHERE len(v) = {width}),
    books0 AS (SELECT part, dense_rank() OVER (ORDER BY rid) - 1 AS entry, p FROM parts QUALIFY entry < {ENTRIES}),
    {','.join(steps)},
    digest AS (
      SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{ROUNDS}),
    coded AS (
      SELECT rid, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
      FROM {last} GROUP BY rid)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN vectors USING (rid), digest"""


def _filter_audit():
    """Each order walked through step by step over the counts per mask."""
    fails = (
        f"len(words) < {LEAST_WORDS}",
        f"100 * len(list_distinct(words)) < {DISTINCT_SHARE} * len(words)",
        f"100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_SHARE} * length(text)",
        "regexp_matches(text, '[#$%&*|]')",
        "coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)",
    )
    bits = " + ".join(f"CASE WHEN {f} THEN {1 << k} ELSE 0 END" for k, f in enumerate(fails))
    order = "a.f || b.f || c.f || d.f || e.f"
    bit = "(1 << (ascii(filter) - 65))"
    before = " + ".join(f"CASE WHEN contains(earlier, '{f}') THEN {1 << k} ELSE 0 END" for k, f in enumerate("ABCDE"))
    return rf"""
    WITH marked AS (
      SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    masked AS (
      SELECT doc_id, part, {bits} AS mask
      FROM (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   [x FOR x IN string_split_regex(coalesce(text, ''), '{GAP}') IF x <> ''] AS words FROM documents)),
    counts AS (
      SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
      FROM masked LEFT JOIN marked USING (doc_id) GROUP BY part, mask),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    orders AS (
      SELECT {order} AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct(string_split({order}, ''))) = 5),
    steps AS (
      SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS earlier
      FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
    walked AS (
      SELECT part, filter_order, step, filter, n, good, toxic, mask, (mask & {bit}) <> 0 AS fails,
             (mask & ({before})) <> 0 AS gone
      FROM counts, steps),
    summed AS (
      SELECT part, filter_order, step, filter,
             CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (mask = {bit}), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
      FROM walked GROUP BY part, filter_order, step, filter)
    SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM summed"""


SQL = {
    "op1_secret_scan": _secret_scan(),
    "op2_decontamination": _decontamination(),
    "op3_quality_rules": _quality_rules(),
    "op8_warc_bundles": _warc_bundles(),
    "op11_url_filters": _url_filters(),
    "op12_vector_codes": _vector_codes(),
    "op13_filter_audit": _filter_audit(),
}
