"""DuckDB SQL for the rows of the queries that SQL can express.

The others have none: a learned model (toxicity, and with it the pipeline), XXH64 (SimHash) and a list of merges
(BPE) are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

#: the words of a text
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents
),
windows AS (
  SELECT n, i, array_to_string(words[i:i + 4], ' ') AS five
  FROM (SELECT n, words, unnest(generate_series(1, len(words) - 4)) AS i FROM docs)
),
twice AS (SELECT n, i FROM windows QUALIFY count(*) OVER (PARTITION BY n, five) > 1),
covered AS (
  SELECT n, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT n, unnest(generate_series(i, i + 4)) AS place FROM twice) GROUP BY n
),
lines AS (
  SELECT n, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY n
),
counted AS (
  SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs LEFT JOIN covered USING (n) LEFT JOIN lines USING (n)
),
ruled AS (
  SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeated,
    10 * n_symbols > n_words AS symbols, 100 * n_dup_lines > 30 * n_lines AS copied_lines,
    n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) AS word_length
  FROM counted
),
failures AS (
  SELECT source, rule, count(*) AS documents, count(*) FILTER (failed) AS failed
  FROM (
    SELECT source, unnest(['short', 'repeated', 'symbols', 'copied_lines', 'word_length']) AS rule,
      unnest([short, repeated, symbols, copied_lines, word_length]) AS failed
    FROM ruled WHERE source IS NOT NULL
  ) GROUP BY source, rule
),
sums AS (
  SELECT rule, count(*) AS hosts, sum(documents)::DOUBLE AS n, sum(documents::DOUBLE * documents) AS nn,
    sum(failed) / sum(documents) AS mean, sum(failed / documents * failed) AS fp
  FROM failures GROUP BY rule
),
moments AS (
  SELECT *, mean * (1 - mean) AS chance, n - nn / n - (hosts - 1) AS freedom FROM sums
),
priors AS (
  SELECT rule, mean, CASE WHEN chance <= 0 OR freedom <= 0 THEN n
    WHEN fp - n * mean * mean - (hosts - 1) * chance <= 0 THEN n
    ELSE greatest(1 / least((fp - n * mean * mean - (hosts - 1) * chance) / (chance * freedom), 0.999) - 1, 0.001)
    END AS strength
  FROM moments
),
rates AS (
  SELECT source, rule, mean, (failed + mean * strength) / (documents + strength) AS rate FROM failures JOIN priors USING (rule)
),
hosts AS (
  SELECT source, max(rate) > 0.5 AS rejected,
    max(CASE rule WHEN 'symbols' THEN CASE WHEN mean > 0 THEN rate / mean ELSE 1 END END) AS symbols_weight,
    max(CASE rule WHEN 'copied_lines' THEN CASE WHEN mean > 0 THEN rate / mean ELSE 1 END END) AS copied_lines_weight,
    max(CASE rule WHEN 'word_length' THEN CASE WHEN mean > 0 THEN rate / mean ELSE 1 END END) AS word_length_weight
  FROM rates GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed,
  NOT (short OR repeated) AND NOT coalesce(rejected, false)
    AND CASE WHEN symbols THEN coalesce(symbols_weight, 1) ELSE 0 END + CASE WHEN copied_lines THEN coalesce(copied_lines_weight, 1) ELSE 0 END
      + CASE WHEN word_length THEN coalesce(word_length_weight, 1) ELSE 0 END < 1 - 1e-9::DOUBLE AS kept
FROM ruled LEFT JOIN hosts USING (source)
"""


def hashed(*parts: str) -> str:
    """A number below 2^52 from the MD5 of the parts."""
    joined = ", ".join(f"coalesce(({part})::VARCHAR, 'null')" for part in parts)
    return f"('0x' || substr(md5(concat_ws(':', {joined})), 1, 13))::BIGINT"


HOST = r"nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"
FOLDER = r"coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)', 1), '')"

OP2 = f"""
WITH captures AS (
  SELECT row_number() OVER () AS n, page_id, url, {HOST} AS host, {FOLDER} AS folder,
    DATE '2024-01-01' + ((page_id * 7919 % 365 + 365) % 365)::INT AS fetched_at
  FROM pages
),
candidates AS (
  SELECT n, host || folder AS pattern, len(string_split(host, '.')) + 1 AS rank FROM captures
  WHERE host IS NOT NULL AND folder <> ''
  UNION ALL
  SELECT n, array_to_string(string_split(host, '.')[i:], '.'), len(string_split(host, '.')) - i + 1
  FROM (SELECT n, host, unnest(generate_series(1, len(string_split(host, '.')))) AS i FROM captures WHERE host IS NOT NULL)
),
drawn AS (
  SELECT pattern, turn FROM (SELECT DISTINCT pattern FROM candidates), (SELECT unnest([0, 1, 2]) AS turn)
  WHERE {hashed("'entry'", "pattern", "turn")} % 3 = 0
),
entries AS (
  SELECT pattern, max((['block', 'allow', 'remove', 'block'])[({hashed("'action'", "pattern", "turn")} % 4 + 1)::INT]) AS action,
    DATE '2024-01-01' + ({hashed("'day'", "pattern", "turn")} % 365)::INT AS since
  FROM drawn GROUP BY pattern, since
),
valid AS (SELECT *, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM entries),
best AS (
  SELECT n, pattern, action, since
  FROM captures JOIN candidates USING (n) JOIN valid USING (pattern)
  WHERE action <> 'remove' AND since <= fetched_at AND (until IS NULL OR fetched_at < until)
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY rank DESC) = 1
)
SELECT page_id, url, fetched_at, pattern, action, since AS listed_at, coalesce(action = 'block', false) AS blocked
FROM captures LEFT JOIN best USING (n)
"""

OP3 = f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS content, len({WORDS}) AS size FROM documents
),
keyed AS (SELECT *, {hashed("'mix'", "doc_id", "content")} AS key FROM sized),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM keyed GROUP BY source
),
levels AS (
  SELECT *, source_size * 2.0::DOUBLE AS most,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER earlier, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM totals
  WINDOW earlier AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
budgets AS (
  SELECT source, source_size, CASE WHEN most <= level * weight OR common IS NULL THEN most ELSE common * weight END AS target
  FROM (SELECT *, max(level) FILTER (most > level * weight) OVER () AS common FROM levels)
),
summed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size, content
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed
),
due AS (
  SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole,
    floor(target)::BIGINT AS words
  FROM summed s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (whole * size + greatest(0, least(words - whole * source_size - before, size)))::BIGINT AS taken
FROM due
"""

#: the base kinds' matches with what lies between them; a failing match still takes its place
SPANS = {
    "assign": (
        r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "length(regexp_extract(hit, '{pattern}', 2)) >= 8",
    ),
    "access": (r"AKIA[A-Z0-9]+", "length(hit) >= 16"),
    "hex": (r"[0-9a-f]+", "length(hit) >= 32"),
}


def shards(count: int) -> str:
    scores = ", ".join(
        f"{{'s': 1.0::DOUBLE / -ln(({hashed("'shard'", f"'{i}'", 'doc_id')} + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE), 'i': {-i}}}"
        for i in range(count)
    )
    return f"(-(list_max([{scores}]).i))::INT"


OP7 = f"""
WITH bytes AS (
  SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    hex(encode(coalesce(text, ''))) AS digits
  FROM documents
),
steps AS (
  SELECT list(list_reduce([byte, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY byte) AS step
  FROM (SELECT unnest(generate_series(0, 255)) AS byte)
),
summed AS (
  SELECT *, (xor(list_reduce(
      [4294967295::BIGINT] || list_transform(generate_series(1, length(digits) - 1, 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT),
      lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])
    ), 4294967295)) AS text_crc32
  FROM bytes, steps
),
placed AS (
  SELECT doc_id, size::BIGINT AS size, text_crc32, {shards(8)} AS shard, {shards(9)} AS grown_shard,
    {hashed("'slot'", "doc_id", "md5(text)")} AS key
  FROM summed
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM placed
"""

OP8 = r"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
hosts AS (SELECT source, count(*) AS pages FROM docs GROUP BY source),
counted AS (
  SELECT source, line, count(*) AS pages
  FROM (SELECT DISTINCT n, source, unnest(lines) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line
),
bad AS (
  SELECT c.source, list(line) AS bad FROM counted c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE c.pages >= 5 AND c.pages > h.pages * 0.01::DOUBLE GROUP BY c.source
),
shorter AS (
  SELECT d.*, list_filter(lines, lambda x: bad IS NULL OR NOT list_contains(bad, x)) AS kept
  FROM docs d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source
),
told AS (
  SELECT *, coalesce(len(kept) < len(lines) AND len(list_filter(kept, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) > 0, false) AS cut
  FROM shorter
)
SELECT doc_id, source, CASE WHEN cut THEN array_to_string(kept, chr(10)) ELSE text END AS text,
  (CASE WHEN cut THEN len(lines) - len(kept) ELSE 0 END)::INT AS lines_dropped
FROM told
"""

OP10 = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM vectors WHERE vec_id % 20 = 0) q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

#: words of letters and digits after A-Z became a-z; anything beyond ASCII is a letter
LOWER_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11 = rf"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, {LOWER_WORDS} AS words FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {LOWER_WORDS} AS words FROM benchmark),
sizes AS (SELECT item, words, least(len(words), 10) AS size FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS read
  FROM (SELECT item, size, words, unnest(generate_series(1, len(words) - size + 1)) AS i FROM sizes)
),
places AS (
  SELECT n, i, size, array_to_string(words[i:i + size - 1], ' ') AS read
  FROM (SELECT n, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM docs, (SELECT DISTINCT size FROM windows))
),
hits AS (SELECT n, i, size, item FROM places JOIN windows USING (size, read)),
covered AS (
  SELECT n, count(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT n, unnest(generate_series(i, i + size - 1)) AS place FROM hits) GROUP BY n
),
named AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT n, item FROM hits) GROUP BY n
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (n) LEFT JOIN named USING (n)
"""

OP12 = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS digits
  FROM conversations
),
steps AS (
  SELECT list(list_reduce([byte, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY byte) AS step
  FROM (SELECT unnest(generate_series(0, 255)) AS byte)
),
summed AS (
  SELECT * EXCLUDE (digits, step), xor(list_reduce(
      [4294967295::BIGINT] || list_transform(generate_series(1, length(digits) - 1, 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT),
      lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS harm
  FROM keyed, steps
),
harmed AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE harm WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM summed WHERE harm <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    CASE substr(role, 1, 1) WHEN 's' THEN 's' WHEN 'u' THEN 'u' WHEN 'a' THEN 'a' ELSE '?' END AS initial,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM harmed
),
rows_ AS (
  SELECT *, last = '' AS blank, last <> '' AND again AS duplicate, last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed)
),
reported AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM rows_) GROUP BY conv_id
),
inserted AS (
  SELECT * FROM (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'), (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')) t(p, m, first)
),
legal AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) t(m, r, q)),
edits AS (
  SELECT p, m AS q, 3 + 2 * length(first) AS price, first || 'D' AS letters, 'any' AS needs FROM inserted
  UNION ALL SELECT p, q, 2 * length(first), first || 'K', r FROM inserted JOIN legal USING (m)
  UNION ALL SELECT p, q, 2 + 2 * length(first), first || 'R', 'good' FROM inserted JOIN legal USING (m) WHERE r <> 's'
),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS p, 0::BIGINT AS cost, '' AS audit FROM reported
  UNION ALL
  (SELECT conv_id, i, q, cost, audit FROM (
    SELECT b.conv_id, r.i, e.q, b.cost + e.price + (e.needs <> 'any' AND r.truncated)::BIGINT AS cost, b.audit || e.letters AS audit
    FROM best b JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
    JOIN edits e ON e.p = b.p AND (e.needs = 'any' OR (NOT r.blank AND NOT r.duplicate AND (e.needs = 'good' OR e.needs = r.initial)))
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1)
),
cheapest AS (
  SELECT b.conv_id, b.cost + t.price AS cost, b.audit || t.letters AS audit
  FROM best b JOIN reported r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = r.n
  JOIN (VALUES (0, 0, ''), (3, 0, ''), (2, 2, 'I'), (1, 4, 'II')) t(p, price, letters) ON t.p = b.p
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + t.price, b.audit || t.letters) = 1
),
letters AS (
  SELECT conv_id, audit, j, substr(audit, j, 1) AS letter, j - length(replace(audit[1:j], 'I', '')) AS inserts,
    length(replace(audit[1:j], 'D', '')) AS place, length(replace(audit, 'D', '')) AS total
  FROM (SELECT conv_id, audit, unnest(generate_series(1, length(audit))) AS j FROM cheapest)
),
repaired AS (
  SELECT l.conv_id, string_agg(
    CASE WHEN letter = 'K' THEN role WHEN place % 2 = 1 - total % 2 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS lines
  FROM letters l LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = j - inserts
  WHERE letter <> 'D' GROUP BY l.conv_id
),
all_ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM all_ids a LEFT JOIN reported r ON a.conv_id IS NOT DISTINCT FROM r.conv_id
LEFT JOIN cheapest c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired p ON a.conv_id IS NOT DISTINCT FROM p.conv_id
"""

OP13 = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS} AS words FROM documents
),
firsts AS (SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text),
told AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(words) < 200,
    100 * len(list_distinct(words)) < 50 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(first_id < d.doc_id, false)
  ] AS fails
  FROM docs d JOIN firsts USING (text) LEFT JOIN told t ON d.doc_id = t.doc_id
),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o
  FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (SELECT o, list_aggregate(list_transform(o, lambda f: chr(64 + f)), 'string_agg', '') AS filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM orders),
told_apart AS (
  SELECT part, filter_order, step, o[step] AS f, good, toxic, fails[o[step]] AS own,
    len(list_filter(o[1:step - 1], lambda f: fails[f])) = 0 AS reached,
    len(list_filter(fails, lambda x: x)) = 1 AS single
  FROM failing, steps
),
counted AS (
  SELECT part, filter_order, step, f, count(*) FILTER (reached AND NOT own) AS kept,
    count(*) FILTER (reached AND own) AS removed, count(*) FILTER (own AND NOT reached) AS redundant,
    count(*) FILTER (own AND single) AS unique_fails, count(*) FILTER (reached AND own AND good) AS good_lost,
    count(*) FILTER (reached AND own AND toxic) AS toxic_lost
  FROM told_apart GROUP BY ALL
)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM counted
"""


def statements() -> dict[str, str]:
    return {
        "op1_host_quality": OP1,
        "op2_url_lists": OP2,
        "op3_mix_sources": OP3,
        "op7_rendezvous_shards": OP7,
        "op8_line_dedup": OP8,
        "op10_exact_topk": OP10,
        "op11_decontaminate": OP11,
        "op12_repair_conversations": OP12,
        "op13_filter_audit": OP13,
    }
