"""SQL that states the results of those operator queries that SQL can express."""

from __future__ import annotations

from corpusloom.llm import line_dedup, near_join, prefix_trie, quality_rules, url_filters, vector_codes
from corpusloom.plans.registry import sql_u


def drawn(n: str | int, seed: str, key: str) -> str:
    """The SQL form of :func:`corpusloom.functions.det.draw_index`."""
    return f"CAST(floor({sql_u(seed, key)} * {n}) AS BIGINT)"


def url_filter_sql(days: int) -> str:
    host = "lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''))"
    path = "regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    kinds = "".join(
        f""" {'UNION ALL' * bool(i)} SELECT '{kind}s' AS list, '{kind}' AS kind, {kind}_rules[{drawn(f'len({kind}_rules)', f'{kind}-rule', 'page_id')} + 1] AS rule,
          {drawn(days, f'{kind}-day', 'page_id')} AS day, {drawn(2, f'{kind}-added', 'page_id')} = 0 AS added FROM ruled"""
        for i, kind in enumerate((url_filters.DOMAIN, url_filters.PREFIX))
    )
    return f"""WITH hosts AS (SELECT page_id, url, {host} AS host, list_filter(string_split({path}, '/'), lambda x: x <> '') AS parts FROM pages),
      labelled AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels FROM hosts),
      ruled AS (SELECT page_id, CASE WHEN len(labels) >= 2 THEN list_transform(range(2, len(labels) + 1), lambda k: array_to_string(labels[len(labels) - k + 1:], '.'))
                       ELSE labels END AS domain_rules,
                CASE WHEN host <> '' THEN list_transform(range(1, len(parts) + 1), lambda k: host || '/' || array_to_string(parts[:k], '/')) ELSE parts[:0] END AS prefix_rules
                FROM labelled),
      entries AS ({kinds}),
      daily AS (SELECT list, kind, rule, day, max(added) AS added FROM entries WHERE rule IS NOT NULL GROUP BY ALL),
      changes AS (SELECT * FROM (SELECT *, lag(added) OVER (PARTITION BY list, kind, rule ORDER BY day) AS was FROM daily) WHERE added <> coalesce(was, false)),
      held AS (SELECT * FROM (SELECT list, kind, rule, day AS since, added, lead(day) OVER (PARTITION BY list, kind, rule ORDER BY day) AS until FROM changes) WHERE added),
      looks AS (SELECT page_id, {drawn(days, 'fetched', 'page_id')} AS day, '{url_filters.DOMAIN}' AS kind, unnest(domain_rules) AS rule FROM ruled
                UNION ALL SELECT page_id, {drawn(days, 'fetched', 'page_id')}, '{url_filters.PREFIX}', unnest(prefix_rules) FROM ruled),
      hits AS (SELECT page_id, count(*) AS n, array_to_string(list_sort(list_distinct(list(list))), ',') AS lists, min(since) AS since
               FROM looks JOIN held USING (kind, rule) WHERE looks.day >= since AND (until IS NULL OR looks.day < until) GROUP BY page_id)
    SELECT page_id, CAST({drawn(days, 'fetched', 'page_id')} AS INT) AS day, coalesce(n, 0) AS n_active, coalesce(lists, '') AS lists, CAST(since AS INT) AS since, n IS NOT NULL AS blocked
    FROM ruled LEFT JOIN hits USING (page_id)"""


def quality_rules_sql() -> str:
    white, symbols, size = r"[\x20\x09-\x0D]", r"[#*$%&|<>]", quality_rules.WINDOW_WORDS
    per = {
        "word_size": "word_chars * 1000 // greatest(n_words, 1)", "symbol_rate": "n_symbols * 1000 // greatest(word_chars, 1)",
        "dup_line_rate": "n_dup_lines * 1000 // greatest(n_lines, 1)", "repeat_rate": "n_repeat_words * 1000 // greatest(n_words, 1)",
    }
    values = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{name}' AS measure, {value} AS value FROM counted" for name, value in per.items())
    shift = f"greatest(length(bin(value)) - {quality_rules.BUCKET_BITS}, 0)"
    levels = ", ".join(
        f"""t{i} AS (SELECT {keys} measure, bucket, sum(sum(n)) OVER (PARTITION BY {keys} measure) AS total, sum(sum(n)) OVER (PARTITION BY {keys} measure ORDER BY bucket) AS upto
             FROM sketches GROUP BY {keys} measure, bucket),
           m{i} AS (SELECT *, min(bucket) FILTER (WHERE upto * 4 >= total) OVER g AS q1, min(bucket) FILTER (WHERE upto * 4 >= total * 3) OVER g AS q3
             FROM t{i} WINDOW g AS (PARTITION BY {keys} measure)),
           b{i} AS (SELECT *, max(upto) FILTER (WHERE bucket <= q3) OVER g AS body FROM m{i} WINDOW g AS (PARTITION BY {keys} measure)),
           q{i} AS (SELECT {keys} measure, max(total) AS total, max(q1) AS q1, max(q3) AS q3,
               min(bucket) FILTER (WHERE bucket > q3 AND (upto - body) * 4 >= total - body) AS t1, min(bucket) FILTER (WHERE bucket > q3 AND (upto - body) * 4 >= (total - body) * 3) AS t3
             FROM b{i} GROUP BY {keys} measure)"""
        for i, keys in enumerate(("lang, source,", "lang,", ""))
    )
    picked = lambda q: f"CASE WHEN q0.total >= {quality_rules.MIN_GROUP} THEN q0.{q} WHEN q1.total >= {quality_rules.MIN_GROUP} THEN q1.{q} ELSE q2.{q} END"
    marks = ", ".join(f"{picked(q)} AS {q}" for q in ("q1", "q3", "t1", "t3"))
    width = lambda v: f"(1 << greatest(length(bin({v})) - {quality_rules.BUCKET_BITS}, 0))"
    both = ", ".join(f"'{name}'" for name, low in quality_rules.MEASURES.items() if low)
    return f"""WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
      w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
      grams AS (SELECT doc_id, i, array_to_string(ws[i:i + {size - 1}], ' ') AS gram FROM w, LATERAL (SELECT unnest(range(1, len(ws) - {size - 2})) AS i)),
      again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
      covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range({size}) t(j) GROUP BY doc_id),
      counted AS (SELECT doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(text, '{white}', '', 'g')) AS word_chars,
                         length(text) - length(regexp_replace(text, '{symbols}', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                         coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines FROM w LEFT JOIN covered USING (doc_id)),
      rates AS ({values}),
      base AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
      sketches AS (SELECT lang, source, measure, (value >> {shift}) << {shift} AS bucket, count(*) AS n FROM rates
                   WHERE doc_id IN (SELECT doc_id FROM base WHERE NOT base_failed) GROUP BY ALL),
      {levels},
      marks AS (SELECT q0.lang, q0.source, measure, {marks} FROM q0 JOIN q1 USING (lang, measure) JOIN q2 USING (measure)),
      tops AS (SELECT *, CASE WHEN q1 = q3 AND t3 IS NOT NULL THEN t3 ELSE q3 END AS top, CASE WHEN q1 = q3 AND t3 IS NOT NULL THEN t3 - t1 ELSE q3 - q1 END AS spread FROM marks),
      limits AS (SELECT *, top + greatest({quality_rules.FENCE} * spread, {width('top')}) AS high, q1 - greatest({quality_rules.FENCE} * (q3 - q1), {width('q1')}) AS low FROM tops),
      inside AS (SELECT doc_id, bool_and(value <= high AND (r.measure NOT IN ({both}) OR value >= low)) AS inside
                 FROM rates r JOIN limits l ON r.lang IS NOT DISTINCT FROM l.lang AND r.source IS NOT DISTINCT FROM l.source AND r.measure = l.measure GROUP BY doc_id)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
           CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND coalesce(inside, true) AS kept FROM base LEFT JOIN inside USING (doc_id)"""


def near_join_sql() -> str:
    num, den = near_join.THRESHOLD
    n = near_join.WORDS
    return f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS ws FROM documents),
      grams AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {n - 1}], ' ') AS gram FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - {n - 1}, 1) + 1)) AS i) WHERE len(ws) > 0),
      sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS s FROM grams GROUP BY doc_id),
      common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
      links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c.n * {den} >= (x.n + y.n - c.n) * {num}),
      reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
      classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reached GROUP BY a),
      copies AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS copy_id, count(*) OVER (PARTITION BY s) AS n_copies FROM sizes)
    SELECT c.doc_id, class_id, coalesce(copy_id, c.doc_id) AS copy_id, coalesce(n_copies, 1) AS n_copies, (SELECT count(*) FROM links WHERE links.a = c.doc_id) AS n_links
    FROM classes c LEFT JOIN copies USING (doc_id)"""


def top_k_sql(k: int, scale: int = 1024) -> str:
    good = "embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0"
    return f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(CAST(c AS DOUBLE) * {scale})) AS x FROM embeddings WHERE {good}),
      scored AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
    SELECT query_id, CAST(n AS INT) AS "rank", vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored) WHERE n <= {k}"""


def line_dedup_sql() -> str:
    white = " || ".join(f"chr({ord(c)})" for c in line_dedup.WHITE)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
      split AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM texts),
      keyed AS (SELECT *, translate(trim(line, {white}), '{upper}', '{upper.lower()}') AS key FROM split),
      shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
      judged AS (SELECT doc_id, place, line, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN shared USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id"""


def vector_codes_sql() -> str:
    """One statement of the start, and two of each round: the parts with their nearest entries, and the entries after it."""
    n, parts = vector_codes.ENTRIES, vector_codes.PARTS
    nearest = """SELECT p.vec_id, p.part, min(struct_pack(d := list_sum(list_transform(list_zip(p.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry := e.entry)) AS best
      FROM pieces p JOIN {books} e USING (part) GROUP BY p.vec_id, p.part"""
    steps = []
    for i in range(vector_codes.ROUNDS):
        steps.append(f"near{i} AS MATERIALIZED ({nearest.format(books=f'books{i}')})")
        steps.append(
            f"""means{i} AS MATERIALIZED (SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY place) AS x FROM (
              SELECT part, entry, place, CAST(sum(v) AS BIGINT) AS s, count(*) AS c FROM (
                SELECT part, best.entry AS entry, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM near{i} JOIN pieces USING (vec_id, part))
              GROUP BY ALL) GROUP BY part, entry)"""
        )
        steps.append(f"books{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM books{i} b LEFT JOIN means{i} m USING (part, entry))")
    last = f"books{vector_codes.ROUNDS}"
    return f"""WITH vectors AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * {vector_codes.SCALE}) AS BIGINT)) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
      cut AS (SELECT vec_id, x, unnest(range({parts})) AS part, len(x) // {parts} AS width FROM vectors),
      pieces AS MATERIALIZED (SELECT vec_id, part, x[part * width + 1:(part + 1) * width] AS x FROM cut),
      starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM vectors ORDER BY vec_id LIMIT {n}),
      books0 AS MATERIALIZED (SELECT part, entry, x FROM pieces JOIN starts USING (vec_id)),
      {", ".join(steps)},
      coded AS MATERIALIZED (SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
        FROM ({nearest.format(books=last)}) GROUP BY vec_id),
      sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN vectors USING (vec_id) GROUP BY label),
      digest AS (SELECT sha256(string_agg(v, ',' ORDER BY part, entry, place)) AS codebooks_sha256
        FROM (SELECT part, entry, CAST(unnest(x) AS VARCHAR) AS v, generate_subscripts(x, 1) AS place FROM {last}))
    SELECT vec_id, code, error, label_error, codebooks_sha256 FROM coded JOIN vectors USING (vec_id)
      JOIN sums ON vectors.label IS NOT DISTINCT FROM sums.label CROSS JOIN digest"""


def prefix_trie_sql(family: int, lent: int) -> str:
    """The checksum is worked out bit by bit: a byte, then eight shifts."""
    shifts = ", -1" * 8
    crc = f"""xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT){shifts}])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
      hashed AS (SELECT conv_id, turn, md5(length(role) || ':' || role || text) AS symbol, len(regexp_extract_all(text, '{prefix_trie.WORD}')) AS words FROM turns),
      convs AS (SELECT conv_id, list(symbol ORDER BY turn NULLS FIRST, symbol) AS symbols, list(words ORDER BY turn NULLS FIRST, symbol) AS words FROM hashed GROUP BY conv_id),
      sized AS (SELECT *, {crc} % {lent} AS h FROM convs),
      rebuilt AS (SELECT c.conv_id, coalesce(f.symbols[1:c.h], []) || c.symbols[c.h + 1:] AS symbols, coalesce(f.words[1:c.h], []) || c.words[c.h + 1:] AS words
                  FROM sized c LEFT JOIN convs f ON f.conv_id = c.conv_id - c.conv_id % {family}),
      members AS (SELECT conv_id, symbols, words, unnest(range(len(symbols) + 1)) AS depth FROM rebuilt),
      nodes AS (SELECT array_to_string(symbols[1:depth], '') AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(words[depth]), 0) AS w,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(symbols) = depth), '')) AS ends_sha256 FROM members GROUP BY path, depth),
      children AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
      full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
      tops AS (SELECT *, unnest(range(depth + 1)) AS above FROM full_nodes),
      sums AS (SELECT left(path, 32 * above) AS path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * w) AS BIGINT) AS saved_tokens FROM tops GROUP BY left(path, 32 * above))
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
    FROM full_nodes n JOIN sums s ON s.path = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 32 * (n.depth - 1))"""
