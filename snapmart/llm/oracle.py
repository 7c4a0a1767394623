"""The queries that SQL can express, in DuckDB's SQL."""

from snapmart.llm.url_filter import LONG_SUFFIXES

# Both levels of moments below mirror the definition of a beta-binomial prior; see each operator's docstring.
_RHO = """greatest(0.01, least(0.95, CASE WHEN sum(mean * (1 - mean) * (n - 1)) > 0
    THEN (sum(n * (bad::DOUBLE / n - mean) ** 2) - sum(mean * (1 - mean))) / sum(mean * (1 - mean) * (n - 1))
    ELSE 0.5 END))"""


def _bound(weight: str) -> str:
    p = f"(({weight} * mean + bad) / ({weight} + n))"
    return f"{p} - 1.645 * sqrt({p} * (1 - {p}) / ({weight} + n + 1))"


def _weighted(level: str) -> str:
    return f"(SELECT 1 / {_RHO} - 1 FROM {level} WHERE n > 0)"


OP2 = f"""
WITH parsed AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) ELSE '' END AS raw,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM parsed),
rules(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
  ('allow', 'com/fr/'), ('block', 'com/de/')),
fitting AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rules.verdict, length(rule)) AS ruled
  FROM split, rules
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY page_id),
ruled AS (SELECT s.*, f.rule, f.ruled FROM split s LEFT JOIN fitting f USING (page_id)),
labels AS (
  SELECT *, CASE WHEN array_to_string(parts[-2:], '.') IN ({', '.join(f"'{s}'" for s in LONG_SUFFIXES)}) THEN 2 ELSE 1 END AS long
  FROM (SELECT *, string_split(host, '.') AS parts FROM ruled)),
hosts0 AS (
  SELECT host, count(*) FILTER (ruled = 'block') AS bad, count(ruled) AS n,
    array_to_string(parts[-long - 1:], '.') AS domain, array_to_string(parts[-long:], '.') AS suffix
  FROM labels GROUP BY host, parts, long),
domains0 AS (SELECT suffix, domain, sum(bad) AS bad, sum(n) AS n FROM hosts0 GROUP BY ALL),
suffixes AS (
  SELECT suffix, sum(bad) AS bad, sum(n) AS n, coalesce(any_value(total.p), 0) AS mean
  FROM domains0, (SELECT sum(bad)::DOUBLE / nullif(sum(n), 0) AS p FROM domains0) total GROUP BY suffix),
domains AS (
  SELECT d.*, (w * s.mean + s.bad) / (w + s.n) AS mean
  FROM domains0 d JOIN suffixes s USING (suffix), (SELECT {_weighted('suffixes')} AS w)),
hosts AS (
  SELECT h.*, (w * d.mean + d.bad) / (w + d.n) AS mean
  FROM hosts0 h JOIN domains d USING (suffix, domain), (SELECT {_weighted('domains')} AS w)),
bounds AS (SELECT host, {_bound('w')} AS bound FROM hosts, (SELECT {_weighted('hosts')} AS w))
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN bound >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN bounds USING (host)"""

_CONTROL = [
    "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
    "<</SYS>>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<start_of_turn>",
    "<end_of_turn>",
]


def _added(text: str) -> str:
    """Code points that escaping adds: one per backslash and one per control string."""
    counts = [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in ["\\", *_CONTROL]]
    return " + ".join(counts)


OP3 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(text) + {_added('text')} + {_added('role')} + {len('<|im_start|><|im_sep|><|im_end|>') + 1})::BIGINT
    AS formatted_chars
FROM turns GROUP BY conv_id"""

OP8 = f"""
WITH worded AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i + 1:i + 5] AS span FROM (SELECT doc_id, words, unnest(range(len(words) - 4)) AS i FROM worded)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, span) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS t(k) GROUP BY doc_id),
measured AS (
  SELECT doc_id, host, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM worded LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts0 AS (SELECT host, count(*) FILTER (base_failed) AS bad, count(*) AS n FROM judged GROUP BY host),
hosts AS (SELECT *, (SELECT sum(bad)::DOUBLE / sum(n) FROM hosts0) AS mean FROM hosts0),
bounds AS (SELECT host, {_bound('w')} AS bound FROM hosts, (SELECT {_weighted('hosts')} AS w))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR bound >= 0.5) AS kept
FROM judged JOIN bounds USING (host)"""

OP10 = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM texts"""

# CRC-32 of a text of ASCII characters, bit by bit: each byte is followed by seven zeros, and each step shifts once.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), lambda x: [unicode(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda crc, x: xor(xor(crc, x) >> 1, CASE WHEN xor(crc, x) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)), 4294967295::BIGINT)"""

# Nodes are prefixes of lists of turns.
OP11 = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY p) AS said FROM turns GROUP BY c),
heads AS (SELECT *, c - c % 100 AS head, {_CRC32.format('c::VARCHAR')} % 6 AS h FROM own),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.said[1:a.h], []), a.said[a.h + 1:]) AS said
  FROM heads a LEFT JOIN own b ON b.c = a.head),
members AS (SELECT c, said[1:d] AS path, d, len(said) = d AS ends FROM (SELECT *, unnest(range(len(said) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, any_value(d) AS depth, count(*) AS n_convs, min(c) AS conv_id, path[1:len(path) - 1] AS above,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ends
  FROM members GROUP BY path),
parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.above),
children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above),
counted AS (SELECT p.*, coalesce(c.n, 0) AS n_children FROM parents p LEFT JOIN children c USING (path)),
up AS (
  SELECT path[1:k] AS path, n_children, (n_convs - 1) * CASE WHEN depth > 0 THEN length(path[depth].text) ELSE 0 END AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM counted)),
totals AS (SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY path)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN totals USING (path)"""

OP12 = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('1|' || coalesce(doc_id::VARCHAR, text, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u
  FROM documents),
rated AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS odds FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS words, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM rated GROUP BY source),
filling AS (
  SELECT *, 2 * words / weight::DOUBLE AS brim,
    (sum(words) OVER () * 1.5::DOUBLE - coalesce(sum(2 * words) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 2 * words / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, words, least((2 * words)::DOUBLE, coalesce((SELECT arg_min(level, brim) FROM filling WHERE level <= brim) * weight, 2 * words)) AS target
  FROM filling),
classes AS (SELECT source, odds, sum(size)::BIGINT AS n FROM rated WHERE odds > 0 GROUP BY ALL),
tried AS (
  SELECT source, odds, (target - 2 * coalesce(sum(n) OVER high, 0))
      / (sum(n * odds) OVER (PARTITION BY source) - coalesce(sum(n * odds) OVER high, 0)) AS rate
  FROM classes JOIN targets USING (source)
  WINDOW high AS (PARTITION BY source ORDER BY odds DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rates AS (SELECT source, coalesce(arg_max(rate, odds) FILTER (rate * odds <= 2), 2) AS rate FROM tried GROUP BY source),
copied AS (
  SELECT r.*, words, target, least(2, coalesce(rate, 0) * odds) AS copies
  FROM rated r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source LEFT JOIN rates k ON r.source IS NOT DISTINCT FROM k.source),
drawn AS (
  SELECT *, floor(copies)::BIGINT AS certain, copies - floor(copies) AS p,
    CASE WHEN copies > floor(copies) THEN size ELSE 0 END AS open FROM copied),
ordered AS (
  SELECT *, round(target)::BIGINT - sum(certain * size) OVER (PARTITION BY source) AS wanted,
    sum(open) OVER (PARTITION BY source ORDER BY CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE 'inf'::DOUBLE END, size, doc_id
      ROWS UNBOUNDED PRECEDING) AS upto
  FROM drawn)
SELECT doc_id, size, words AS source_size, target, (certain * size + greatest(0, least(open, greatest(wanted, 0) - (upto - open))))::BIGINT AS taken,
  source, certain
FROM ordered"""

# The cheapest edits by dynamic programming: per turn read and last role written (0 none, 1 system, 2 user, 3 assistant).
# Of paths to one state with equal costs none is the beginning of another, so the least text stays the least.
OP13 = f"""
WITH RECURSIVE faulty AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM faulty, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS t(copy)),
numbered AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN body[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM numbered),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
inserts(q, q2, edits, lines) AS (VALUES (0, 0, '', []), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
  (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 3, 'I', ['assistant:']), (2, 2, 'II', ['assistant:', 'user:']), (3, 2, 'I', ['user:']), (3, 3, 'II', ['user:', 'assistant:'])),
keeps(q, initial, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
paths AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT p.conv_id, j.i, e.q3, min({{'cost': p.best.cost + 2 * length(n.edits) + e.cost,
    'audit': p.best.audit || n.edits || e.edit, 'lines': list_concat(p.best.lines, n.lines, e.lines)}})
  FROM paths p JOIN inserts n ON n.q = p.q
    JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1
    LEFT JOIN keeps k ON k.q = n.q2 AND k.initial = j.initial,
    (VALUES ('D'), ('K'), ('R')) AS edits(edit),
    LATERAL (SELECT edits.edit, CASE edits.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN edits.edit <> 'D' AND j.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
      CASE edits.edit WHEN 'D' THEN n.q2 WHEN 'K' THEN k.q2 ELSE [2, 2, 3, 2][n.q2 + 1] END AS q3,
      CASE edits.edit WHEN 'D' THEN [] WHEN 'K' THEN [j.role || ':' || j.text]
        ELSE [[ 'user:', 'user:', 'assistant:', 'user:'][n.q2 + 1] || j.text] END AS lines) AS e
  WHERE e.q3 IS NOT NULL AND (e.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
  GROUP BY p.conv_id, j.i, e.q3),
ended AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + 2 * length(n.edits), 'audit': p.best.audit || n.edits, 'lines': list_concat(p.best.lines, n.lines)}}) AS best
  FROM paths p JOIN inserts n ON n.q = p.q AND n.q2 IN (0, 3) LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id
  WHERE p.i = coalesce(c.n, 0) GROUP BY p.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
  sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""

ORACLE = {
    "op11_prefix_trie": OP11, "op12_mixing": OP12, "op13_conversation_repair": OP13,
    "op10_exact_dedup": OP10, "op2_url_filters": OP2, "op3_chat_format": OP3,
    "op8_quality_rules": OP8,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
