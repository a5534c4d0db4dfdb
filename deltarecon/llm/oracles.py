"""DuckDB SQL for those queries of this folder that SQL can express."""

from deltarecon.llm import licenses as _l
from deltarecon.llm import mixing as _m
from deltarecon.llm import quality as _q

_SPACE = r"[\x20\x09-\x0D]+"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, list_filter(string_split_regex(text, '{_SPACE}'), lambda w: w <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), g AS (
  SELECT *, list_filter(lines, lambda l: regexp_matches(l, {_text(_q.SENTENCE_END)})
      AND length(l) - length(regexp_replace(l, {_text(_q.NOISE)}, '', 'g')) <= length(l) * {_q.MAX_NOISE}
      AND NOT regexp_matches(l, {_text(_q.NAVIGATION)}) AND NOT regexp_matches(l, {_text(_q.BOILERPLATE)})) AS good
  FROM w
), win AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS s,
    unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) AS x
  FROM w WHERE len(ws) >= 3
), again AS (
  SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([s, s + 1, s + 2]) AS p FROM again) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '{_q.SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    length(array_to_string(lines, '')) AS before, length(array_to_string(good, '')) AS after
  FROM g LEFT JOIN repeated USING (r)
), v AS (
  SELECT *, n_words < {_q.MIN_WORDS} OR 100 * n_repeat_words > {_q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND CASE WHEN before > 0 THEN 1 - after / before ELSE 0 END <= {_q.MAX_LOST} AS kept
FROM v
"""

_DOC_WORDS = r"""string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP9 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter({_DOC_WORDS}, lambda w: w <> '') AS ws FROM documents
), i AS (
  SELECT item_id, list_filter({_DOC_WORDS}, lambda w: w <> '') AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k,
    unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2),
                          lambda s: array_to_string(ws[s:s + least(len(ws), 10) - 1], ' '))) AS win
  FROM i WHERE len(ws) > 0
), ks AS (
  SELECT DISTINCT k FROM iw
), dw AS (
  SELECT r, k, unnest(range(1, len(ws) - k + 2)) AS s,
    unnest(list_transform(range(1, len(ws) - k + 2), lambda s: array_to_string(ws[s:s + k - 1], ' '))) AS win
  FROM d, ks WHERE len(ws) >= k
), hit AS (
  SELECT dw.r, dw.s, dw.k, iw.item_id FROM dw JOIN iw USING (k, win)
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

def _bisected(measure: str, up: str) -> str:
    """A recursive query's halving step: ``measure`` is of ``mid`` over the list ``p``."""
    return f"""
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN mid ELSE low END, CASE WHEN up THEN high ELSE mid END
  FROM (SELECT i, low, high, mid, {measure} {up} AS up
        FROM (SELECT i, low, high, (low + high) / 2 AS mid FROM SELF WHERE i < {_m.HALVINGS}) b, shares)"""


def _powers(a: str) -> str:
    return f"list_sum(list_transform(p, lambda x: x ** {a}))"


_OP1 = rf"""
WITH RECURSIVE rows0 AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS key,
    CAST(len(list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '')) AS BIGINT) AS n_tokens
  FROM documents
), src AS (
  SELECT key, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM rows0 GROUP BY key HAVING sum(n_tokens) > 0
), shares AS (
  SELECT list(tokens / total ORDER BY key) AS p, list(CAST(tokens AS DOUBLE) ORDER BY key) AS t, any_value(total) AS total
  FROM src, (SELECT CAST(sum(tokens) AS DOUBLE) AS total FROM src)
), by_entropy AS ({_bisected(
    f"ln({_powers('mid')}) - mid * list_sum(list_transform(p, lambda x: x ** mid * ln(x))) / {_powers('mid')}",
    f"> {_m.TARGET_ENTROPY} * ln(len(p))").replace("SELF", "by_entropy")}
), by_repeats AS ({_bisected(
    f"list_max(list_transform(p, lambda x, k: x ** mid / t[k])) * total / {_powers('mid')}",
    f"> {_m.MAX_REPEATS}").replace("SELF", "by_repeats")}
), exponent AS (
  SELECT CASE WHEN len(p) = 1 THEN 1.0::DOUBLE
    ELSE greatest((SELECT (low + high) / 2 FROM by_entropy WHERE i = {_m.HALVINGS}),
                  (SELECT (low + high) / 2 FROM by_repeats WHERE i = {_m.HALVINGS})) END AS a
  FROM shares
), weights AS (
  SELECT key, tokens, (tokens / total) ** a / {_powers('a')} AS weight,
    CAST(floor((tokens / total) ** a / {_powers('a')} * total + 0.5) AS BIGINT) AS budget
  FROM src, shares, exponent
), dealt AS (
  SELECT doc_id, source, n_tokens, key, tokens, weight, budget,
    CAST(floor(CAST('0x' || substr(md5(concat_ws('/', '{_m.SEED}', 'block', coalesce(CAST(doc_id AS VARCHAR), '-'),
      n_tokens)), 1, 8) AS BIGINT) / 4294967296.0 * ceil(tokens / {float(_m.BLOCK_TOKENS)})) AS BIGINT) AS block
  FROM rows0 JOIN weights USING (key)
), turns AS (
  SELECT *, unnest(range(0, CAST(floor(budget / tokens) AS BIGINT) + 1)) AS epoch FROM dealt
), placed AS (
  SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (
      PARTITION BY key, epoch
      ORDER BY md5(concat_ws('/', '{_m.SEED}', 'epoch', epoch, key, block)), block,
        md5(concat_ws('/', '{_m.SEED}', 'turn', epoch, coalesce(CAST(doc_id AS VARCHAR), '-'), n_tokens)), doc_id, n_tokens
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_token
  FROM turns
)
SELECT doc_id, source, n_tokens, epoch, CAST(start_token AS BIGINT) AS start_token, round(weight, 9) AS weight,
  round((start_token + n_tokens / 2) / budget, 9) AS mix_at
FROM placed WHERE start_token < budget
"""

def _template_rows() -> str:
    rows = (f"({i}, '{name}', {len(pairs)}, [{', '.join(repr(' '.join(p)) for p in sorted(pairs))}])"
            for i, (name, text) in enumerate(_l.TEMPLATES) for pairs in [_l.template_bigrams(text)])
    return ", ".join(rows)


_OP2 = rf"""
WITH t(i, name, n, pairs) AS (VALUES {_template_rows()}
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), u AS (
  SELECT r, doc_id, list_filter(list_distinct(list_concat(
    string_split_regex(text, '{_l.SENTENCE_BREAK}'), string_split(text, chr(10)),
    string_split_regex(text, '{_l.PARAGRAPH_BREAK}'), [text])), lambda x: x <> '') AS units FROM d
), uw AS (
  SELECT r, unnest(range(len(units))) AS k, list_filter(string_split_regex(
    translate(unnest(units), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{_l.BETWEEN_WORDS}'), lambda w: w <> '') AS ws FROM u
), up AS (
  SELECT r, k, list_distinct(list_transform(range(1, len(ws)), lambda j: ws[j] || ' ' || ws[j + 1])) AS pairs
  FROM uw WHERE len(ws) > 1
), scored AS (
  SELECT r, k, name, len(list_intersect(up.pairs, t.pairs)) AS shared, len(up.pairs) + t.n AS sizes
  FROM up JOIN t ON t.n * {_l.MIN_PERCENT} <= len(up.pairs) * {_l.WIDE} AND len(up.pairs) * {_l.MIN_PERCENT} <= t.n * {_l.WIDE}
), seg AS (
  SELECT r, unnest(range(len(q))) AS s, unnest(q) AS ws FROM (
    SELECT r, list_filter(list_transform(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{_l.SENTENCE_BREAK}'), lambda x: list_filter(string_split_regex(x, '{_l.BETWEEN_WORDS}'), lambda w: w <> '')),
      lambda x: len(x) > 0) AS q FROM d)
), word AS (
  SELECT r, s, w, row_number() OVER (PARTITION BY r ORDER BY s, j) - 1 AS i
  FROM (SELECT r, s, unnest(ws) AS w, unnest(range(len(ws))) AS j FROM seg)
), pair AS (
  SELECT r, s, i, w || ' ' || lead(w) OVER (PARTITION BY r ORDER BY i) AS p FROM word
), tp AS (
  SELECT i AS k, n, name, unnest(pairs) AS p FROM t
), shared AS (
  SELECT r, s, i, k, n, name, p FROM pair JOIN tp USING (p)
), near AS (
  SELECT r, k FROM shared GROUP BY r, k HAVING count(DISTINCT p) * {_l.WIDE} >= any_value(n) * {_l.MIN_PERCENT}
), dense AS (
  SELECT r, k, s, a, e, s - row_number() OVER (PARTITION BY r, k ORDER BY s) AS island
  FROM near JOIN (SELECT r, k, s, count(*) AS m FROM shared GROUP BY r, k, s) USING (r, k)
  JOIN (SELECT r, s, min(i) AS a, max(i) + 1 AS e, count(p) AS n FROM pair GROUP BY r, s) USING (r, s)
  WHERE 2 * m >= n
), island AS (
  SELECT r, k, island, min(a) AS a, max(e) AS e FROM dense GROUP BY r, k, island
), run AS (
  SELECT r, k, x.a AS a, y.e AS e FROM island x JOIN island y USING (r, k) JOIN t ON t.i = k
  WHERE x.island = y.island OR y.e > x.a AND (y.e - x.a - 1) * {_l.MIN_PERCENT} <= t.n * {_l.WIDE}
), run_size AS (
  SELECT r, k, a, e, count(DISTINCT p) AS size
  FROM run JOIN pair USING (r) WHERE i >= a AND i < e - 1 GROUP BY r, k, a, e
), run_shared AS (
  SELECT r, k, a, e, count(DISTINCT p) AS shared FROM run JOIN shared USING (r, k) WHERE i >= a AND i < e - 1 GROUP BY r, k, a, e
), scored_runs AS (
  SELECT r, CAST(NULL AS BIGINT) AS k, name, shared, size + n AS sizes
  FROM run_size JOIN run_shared USING (r, k, a, e) JOIN t ON t.i = k
  WHERE n * {_l.MIN_PERCENT} <= size * {_l.WIDE} AND size * {_l.MIN_PERCENT} <= n * {_l.WIDE}
), hit AS (
  SELECT *, 2.0 * shared / sizes AS dice FROM (SELECT * FROM scored UNION ALL SELECT * FROM scored_runs)
  WHERE 200 * shared >= {_l.MIN_PERCENT} * sizes
), agg AS (
  SELECT r, count(DISTINCT k) AS n_matched, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
    max(dice) AS best_dice FROM hit GROUP BY r
), first AS (
  SELECT r, min(name) AS best_license FROM hit JOIN agg USING (r) WHERE hit.dice = agg.best_dice GROUP BY r
)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n_units, coalesce(n_matched, 0) AS n_matched,
  coalesce(licenses, '') AS licenses, round(best_dice, 9) AS best_dice, best_license
FROM u LEFT JOIN agg USING (r) LEFT JOIN first USING (r)
"""

ORACLES = {
    "op1_temperature_mixing": _OP1,
    "op2_license_scan": _OP2,
    "op5_line_quality_rules": _OP5,
    "op9_benchmark_decontamination": _OP9,
}
