"""The same results in DuckDB SQL, where SQL can express them.

Approximate search, label models, merges of byte pairs, unigram segmentation and the
Bloom-filter model are not SQL; tests hold those operators against brute force.
"""

from __future__ import annotations

from tapeloom.llm import merkle, orchard
from tapeloom.llm.fm_index import WINDOW
from tapeloom.llm.fm_index import WORD as ITEM_WORD
from tapeloom.llm.mixing import MOST_REPEATS, SEED, WEIGHTS
from tapeloom.llm.quality import BOILERPLATE, OTHER_END_MARKS, LineRules
from tapeloom.llm.secret_scan import ADDED_RULES, BASE_RULES
from tapeloom.llm.substring_dedup import MIN_WORDS, REACH

WORD = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every row by itself, as ids may be null or repeat.
ROWS = "docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"

OP1 = rf"""
WITH RECURSIVE {ROWS},
words AS (SELECT r, doc_id, regexp_extract_all({LOWER.format("t")}, {WORD}) AS w FROM docs),
shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT w.r, w.doc_id, count(s) AS n FROM words w LEFT JOIN shingles USING (r) GROUP BY ALL),
pairs AS (
  SELECT a.r AS a, b.r AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r
  GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (
  SELECT r AS a, r AS b FROM docs
  UNION
  SELECT reach.a, e.b FROM reach JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) e ON reach.b = e.a)
SELECT s.doc_id, s.n AS n_shingles, min(o.doc_id) AS component_id
FROM sizes s JOIN reach ON reach.a = s.r JOIN sizes o ON o.r = reach.b
GROUP BY s.r, s.doc_id, s.n"""

_AROUND = " AND ".join(
    f"(coalesce({side}(line, {d}) OVER o, -1) <> line OR h < {side}(h, {d}) OVER o)"
    for d in range(1, REACH + 1)
    for side in ("lag", "lead")
)
OP2 = rf"""
WITH {ROWS},
parts AS (
  SELECT r, doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS i
  FROM (SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS p FROM docs)),
placed AS (
  SELECT *, sum(length(part)) OVER w - length(part) AS start, sum(length(part)) OVER w AS stop,
    sum(length(part) - length(replace(part, chr(10), ''))) OVER w AS line
  FROM parts WINDOW w AS (PARTITION BY r ORDER BY i)),
words AS (
  SELECT *, count(*) OVER (PARTITION BY r, line) AS in_line, {LOWER.format("part")} AS word, ('0x' || substr(md5({LOWER.format("part")}), 1, 8))::BIGINT AS h
  FROM placed WHERE regexp_matches(part, '[^\x20\x09-\x0D]')),
cuts AS (
  SELECT *, (coalesce(lead(line) OVER o, -1) <> line) OR (in_line >= {MIN_WORDS} AND ({_AROUND})) AS last
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(last::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS unit FROM cuts),
units AS (
  SELECT r, doc_id, unit, min(start) AS start, max(stop) AS stop, count(*) AS words, min(in_line) < {MIN_WORDS} AS whole,
    string_agg(word, ' ' ORDER BY i) AS body
  FROM numbered GROUP BY r, doc_id, unit),
ranked AS (
  SELECT *, row_number() OVER g AS place, first_value(doc_id) OVER g AS kept
  FROM units WINDOW g AS (PARTITION BY body ORDER BY doc_id NULLS LAST, r, unit)),
later AS (
  SELECT *, unit - row_number() OVER (PARTITION BY r ORDER BY unit) AS near FROM ranked WHERE place > 1),
gone AS (
  SELECT * FROM later QUALIFY whole OR sum(words) OVER (PARTITION BY r, near) >= {MIN_WORDS}),
runs AS (SELECT *, unit - row_number() OVER (PARTITION BY r ORDER BY unit) AS run FROM gone)
SELECT any_value(doc_id) AS doc_id, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop,
  sum(words)::BIGINT AS n_words, min(kept) AS kept_doc_id
FROM runs GROUP BY r, run"""


def _found(rules: list, table: str) -> str:
    """Places of matches: they are marked, the text is split at the marks, lengths are summed."""
    each = []
    for order, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        least = f"AND length(regexp_extract(v, '{pattern}', {rule.group})) >= {rule.least}" if rule.least else ""
        each.append(rf"""
  SELECT r, {order} AS kind_order, '{rule.kind}' AS kind, stop - length(v) AS start, stop FROM (
    SELECT r, i, v, sum(length(v)) OVER (PARTITION BY r ORDER BY i) AS stop FROM (
      SELECT r, unnest(p) AS v, generate_subscripts(p, 1) AS i FROM (
        SELECT r, string_split(regexp_replace(translate(t, chr(57344), chr(57345)), '{pattern}',
          chr(57344) || '\0' || chr(57344), 'g'), chr(57344)) AS p FROM {table})
      WHERE len(p) > 1))
  WHERE i % 2 = 0 {least}""")
    return " UNION ALL ".join(each)


_BASE = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
_COUNTS = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES)
OP3 = rf"""
WITH {ROWS},
found AS ({_found(BASE_RULES + ADDED_RULES, "docs")}),
joined AS (
  SELECT r, {_COUNTS},
    coalesce(string_agg(s, ',' ORDER BY start, kind_order) FILTER (kind IN ({_BASE})), '') AS base,
    string_agg(s, ',' ORDER BY start, kind_order) AS spans
  FROM (SELECT *, kind || ':' || start::BIGINT || ':' || stop::BIGINT AS s FROM found) GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)"""

OP4 = rf"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORD})) AS size,
    md5(coalesce(text, '')) AS digest FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    {WEIGHTS}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - {MOST_REPEATS} * coalesce(sum(source_size) OVER b, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level,
    row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW b AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
  SELECT arg_min(level, place) AS level FROM levels
  WHERE ({MOST_REPEATS} * source_size)::DOUBLE >= level * weight),
rates AS (
  SELECT source, source_size, least(({MOST_REPEATS} * source_size)::DOUBLE,
    coalesce(water.level * weight, ({MOST_REPEATS} * source_size)::DOUBLE)) AS target
  FROM levels, water),
drawn AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || digest), 1, 13))::BIGINT::DOUBLE
      / {16**13}::DOUBLE AS draw
  FROM sizes JOIN rates ON sizes.source IS NOT DISTINCT FROM rates.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + (draw < rate - floor(rate))::INT))::BIGINT AS taken
FROM drawn"""

_RULES = LineRules()
_PHRASES = " OR ".join(f"contains({LOWER.format('line')}, '{phrase.decode()}')" for phrase in BOILERPLATE)
_OTHER_MARKS = "".join(mark.decode() for mark in OTHER_END_MARKS)
OP6 = rf"""
WITH {ROWS},
words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT r, regexp_extract_all(t, {WORD}) AS w FROM docs)),
windows AS (
  SELECT r, i, CASE WHEN lead(word, 4) OVER o IS NOT NULL THEN word || ' ' || lead(word, 1) OVER o || ' ' ||
    lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o END AS five
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT r, i, (five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1)::INT AS found FROM windows),
covered AS (
  SELECT r, max(found) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS found
  FROM twice),
repeats AS (SELECT r, sum(found) AS n_repeat_words FROM covered GROUP BY r),
lines AS (
  SELECT r, line, i, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS dup,
    regexp_extract_all(line, {WORD}) AS w
  FROM (SELECT r, unnest(l) AS line, generate_subscripts(l, 1) AS i
    FROM (SELECT r, string_split(t, chr(10)) AS l FROM docs))
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT r, dup, length(array_to_string(w, '')) AS chars,
    dup OR {_PHRASES}
    OR len(list_filter(w, lambda x: x IN ('|', '>', '»', '›'))) >= {_RULES.separator_words}
    OR 100 * len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]'))) > {_RULES.symbol_percent} * len(w)
    OR (len(w) >= {_RULES.unpunctuated_words} AND NOT regexp_matches(line, '[.!?:;,"'')\]}}{_OTHER_MARKS}]')) AS fails
  FROM lines),
by_line AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (dup) AS n_dup_lines, count(*) FILTER (fails) AS n_failed_lines,
    coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars FROM judged GROUP BY r),
counted AS (
  SELECT doc_id, len(regexp_extract_all(t, {WORD})) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
    coalesce(lost_chars, 0) AS lost_chars
  FROM docs LEFT JOIN by_line USING (r) LEFT JOIN repeats USING (r)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND 100 * lost_chars <= {_RULES.lost_percent} * word_chars AS kept FROM based"""

_LEVELS = 6  # a tree of the SQL has at most 16^6 leaves


def _tree(name: str, nodes: str) -> str:
    """Levels and runs of the trees of `nodes` (tree, i, d), as common table expressions."""
    parts = [f"{name}0 AS (SELECT tree, i, d, count(*) OVER (PARTITION BY tree) AS n FROM {nodes})"]
    for k in range(_LEVELS):
        parts.append(f"""
{name}_runs{k} AS MATERIALIZED (
  SELECT tree, i // {merkle.FAN} AS g, any_value(n) AS n, list(d ORDER BY i) AS run FROM {name}{k} GROUP BY ALL),
{name}{k + 1} AS MATERIALIZED (
  SELECT tree, g AS i, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS d,
    (n + {merkle.FAN - 1}) // {merkle.FAN} AS n FROM {name}_runs{k})""")
    return ",".join(parts)


def _climb(name: str, start: str) -> str:
    """From `start` (r, tree, i, proof, x) up all levels: siblings are added to proof, x is folded."""
    parts, below = [], start
    for k in range(_LEVELS):
        place = f"(s.i // {merkle.FAN**k}) % {merkle.FAN}"
        left, right = f"array_to_string(run[1:{place}], '')", f"array_to_string(run[{place} + 2:], '')"
        parts.append(f"""
{name}_up{k} AS (
  SELECT s.r, s.tree, s.i, CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof,
    CASE WHEN n = 1 THEN x ELSE sha256({left} || x || {right}) END AS x
  FROM {below} s JOIN {name}_runs{k} t ON t.tree = s.tree AND t.g = s.i // {merkle.FAN ** (k + 1)})""")
        below = f"{name}_up{k}"
    return ",".join(parts)


def _leaf(text: str) -> str:
    fields = [text if name == "text" else f"{name}::VARCHAR" for name in merkle.FIELDS]
    return f"sha256({' || '.join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in fields)})"


# the checksum's polynomial, bit by bit over the digits of an id
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)))"""

OP11 = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC32} % {merkle.TAMPERED_EVERY} = 0
      THEN {_leaf(LOWER.format("text"))} END AS changed
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM docs),
leaves AS (SELECT tree, i, leaf AS d FROM placed),
{_tree("a", "leaves")},
subroots AS (SELECT 0 AS tree, tree AS i, d FROM a{_LEVELS}),
{_tree("b", "subroots")},
start AS (SELECT r, tree, i, '' AS proof, coalesce(changed, leaf) AS x FROM placed),
{_climb("a", "start")},
over AS (SELECT r, 0 AS tree, tree AS i, proof, x FROM a_up{_LEVELS - 1}),
{_climb("b", "over")}
SELECT doc_id, leaf, s.d AS subroot, b{_LEVELS}.d AS root, sha256(proof) AS proof_sha256, x AS folded_root,
  x = b{_LEVELS}.d AS verified
FROM placed JOIN b_up{_LEVELS - 1} USING (r) JOIN subroots s ON s.i = placed.tree, b{_LEVELS}"""

OP12 = rf"""
WITH {ROWS},
words AS (SELECT r, doc_id, regexp_extract_all({LOWER.format("t")}, '{ITEM_WORD}') AS w FROM docs),
items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{ITEM_WORD}') AS w
  FROM benchmark),
phrases AS (
  SELECT DISTINCT item, size, unnest(list_transform(range(1, len(w) - size + 2),
    lambda i: array_to_string(w[i:i + size - 1], ' '))) AS s
  FROM (SELECT *, least({WINDOW}, len(w)) AS size FROM items WHERE len(w) > 0)),
windows AS (
  SELECT r, size, unnest(range(1, len(w) - size + 2)) AS i, unnest(list_transform(range(1, len(w) - size + 2),
    lambda i: array_to_string(w[i:i + size - 1], ' '))) AS s
  FROM words, (SELECT DISTINCT size FROM phrases)),
hits AS (SELECT r, i, size, item FROM windows JOIN phrases USING (size, s)),
hit_words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (
  SELECT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r),
found AS (
  SELECT r, count(item) AS n_items, coalesce(string_agg(item, ',' ORDER BY item), '') AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (r) LEFT JOIN found USING (r)"""


def _assigned(number: int) -> str:
    return f"""
near{number} AS MATERIALIZED (
  SELECT r, part, min({{'d': d, 'entry': entry}}) AS best FROM (
    SELECT r, part, entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
    FROM parts c JOIN book{number} b USING (part, place) GROUP BY ALL) GROUP BY ALL)"""


_ROUNDS = ",".join(
    _assigned(number)
    + f""",
sums{number} AS (
  SELECT part, best.entry AS entry, place, sum(x)::BIGINT AS s, count(*) AS n
  FROM parts JOIN near{number} USING (r, part) GROUP BY ALL),
book{number + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce((s - (s % n + n) % n) // n, x) AS x
  FROM book{number} LEFT JOIN sums{number} USING (part, entry, place))"""
    for number in range(orchard.ROUNDS)
)

OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, k * {orchard.PARTS} // n AS part, k % (n // {orchard.PARTS}) AS place, floor({orchard.SCALE} * x::DOUBLE)::BIGINT AS x
  FROM (SELECT r, len(v) AS n, unnest(v) AS x, unnest(range(len(v))) AS k FROM kept)),
book0 AS (SELECT part, r AS entry, place, x FROM parts WHERE r < {orchard.ENTRIES}),
{_ROUNDS},
{_assigned(orchard.ROUNDS)},
codes AS (
  SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM near{orchard.ROUNDS} GROUP BY r),
digest AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{orchard.ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), digest"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": OP1,
    "op2_substring_dedup": OP2,
    "op3_secret_scans": OP3,
    "op4_mixing": OP4,
    "op6_quality_rules": OP6,
    "op11_merkle_manifest": OP11,
    "op12_decontamination": OP12,
    "op13_vector_codes": OP13,
}
