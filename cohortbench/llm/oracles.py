"""DuckDB SQL of the registered queries that SQL can express.

Left out: hashes that DuckDB lacks (SimHash), learnt models (personal data, toxicity) and approximate
search. Tests hold those against brute force. FP-growth's rules are counted here from all token sets.
"""

from cohortbench.llm import topk
from cohortbench.llm.chat import TURNS_PER_PART
from cohortbench.llm.common import RANK_ROWS
from cohortbench.llm.mixing import BLOCK_ROWS, FAIR_SLOTS, LONGEST_PERIOD, PERIOD, TEMPER
from cohortbench.llm.packing import BUCKETS, BUDGET, MAX_LENGTH
from cohortbench.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS
from cohortbench.llm.resampling import Resampling
from cohortbench.llm.rules import URL_RULES
from cohortbench.llm.url_rules import BLOCK, LOWER, UPPER, Mining

WORD = r"[^\x20\x09-\x0D]+"


def rank_sql(group: str, order: str, rows: str) -> str:
    """The rank of ``global_rank``: by bucket, hash, then the order itself."""
    digest = f"md5(concat_ws('|', {order}))"
    bucket = f"(('0x' || substr({digest}, 1, 8))::BIGINT % greatest(1, ceil({rows} / {RANK_ROWS}))::BIGINT)"
    return f"row_number() OVER (PARTITION BY {group} ORDER BY {bucket}, {digest}, {order}) - 1"


def tagged(tag: str, parts: str) -> str:
    return (f"list_transform(list_filter({parts}, lambda p: p <> ''), "
            f"lambda p: '{tag}:' || regexp_replace(p, '[0-9]+', '#', 'g'))")


def url_sql(mining: Mining = Mining()) -> str:
    longest = sorted(URL_RULES, key=lambda r: -len(r.text))
    fits = [(r, f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')") for r in longest]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r.text}'" for r, f in fits) + " END"
    listed = "CASE rule " + " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in longest) + " END"
    tokens = " || ".join([
        tagged("scheme", "[regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)]"),
        tagged("top", "[labels[-1]]"), tagged("host", "list_slice(labels, 1, len(labels) - 1)"),
        tagged("word", "flatten(list_transform(list_filter(labels, lambda p: contains(p, '-')), lambda p: string_split(p, '-')))"),
        tagged("folder", "list_slice(string_split(path, '/'), 1, len(string_split(path, '/')) - 1)"),
        tagged("ending", r"[regexp_extract(path, '\.([A-Za-z0-9]{1,8})$', 1)]"),
        tagged("key", r"list_transform(string_split(regexp_extract(url, '(?s)\?([^#]*)', 1), '&'), lambda p: split_part(p, '=', 1))"),
        tagged("mark", "[CASE WHEN contains(url, '#') THEN 'yes' ELSE '' END]"),
    ])
    return rf"""
WITH u AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, string_split(host, '.') AS labels, {rule} AS rule FROM u),
b AS (SELECT page_id, host, path, rule, {listed} AS listed,
        CASE WHEN host = '' THEN []::VARCHAR[] ELSE list_sort(list_distinct({tokens})) END AS tokens FROM r),
m AS (SELECT doc_id AS page_id, bool_or(quality = 0 OR toxic = 1) AS marked FROM labels
      WHERE doc_id IS NOT NULL GROUP BY doc_id),
k AS (SELECT tokens, coalesce(marked, listed = '{BLOCK}') AS block FROM b LEFT JOIN m USING (page_id)),
g AS (SELECT row_number() OVER () AS i, tokens, count(*) AS n, count(*) FILTER (WHERE block) AS bad
      FROM k WHERE block IS NOT NULL AND len(tokens) > 0 GROUP BY tokens),
o AS (SELECT t, list(i ORDER BY i) AS places FROM (SELECT i, unnest(tokens) AS t FROM g) GROUP BY t),
q AS (SELECT t, min(t) OVER (PARTITION BY places) AS item FROM o),
e AS (SELECT DISTINCT i, item AS t, n, bad FROM (SELECT i, unnest(tokens) AS t, n, bad FROM g) JOIN q USING (t)),
s AS (
  SELECT [t] AS needs, n, bad FROM e
  UNION ALL SELECT [x.t, y.t], x.n, x.bad FROM e x JOIN e y ON x.i = y.i AND x.t < y.t
  UNION ALL SELECT [x.t, y.t, z.t], x.n, x.bad FROM e x JOIN e y ON x.i = y.i AND x.t < y.t
            JOIN e z ON x.i = z.i AND y.t < z.t),
c AS (SELECT needs, sum(bad)::DOUBLE / sum(n)::DOUBLE AS confidence, sum(bad)::DOUBLE / (SELECT sum(n) FROM g) AS support
      FROM s GROUP BY needs HAVING sum(bad) >= ceil({mining.min_support} * (SELECT sum(n) FROM g))
        AND sum(bad)::DOUBLE / sum(n)::DOUBLE >= {mining.min_confidence}),
f AS (SELECT *, array_to_string(needs, ' ') AS text FROM c WHERE len(needs) = 1 OR NOT EXISTS (
        SELECT 1 FROM c o WHERE len(o.needs) = 1 AND list_contains(c.needs, o.needs[1]) AND o.confidence >= c.confidence)),
a AS (SELECT tokens, arg_max(text, (confidence, support, text)) AS mined, max(confidence) AS confidence
      FROM (SELECT tokens, list(DISTINCT item) AS items
            FROM (SELECT DISTINCT tokens, unnest(tokens) AS t FROM b WHERE listed IS NULL) JOIN q USING (t) GROUP BY tokens)
      JOIN f ON list_has_all(items, needs) GROUP BY tokens)
SELECT page_id, host, path, rule, coalesce(listed, CASE WHEN mined IS NOT NULL THEN '{BLOCK}' ELSE 'allow' END) AS verdict,
  CASE WHEN listed IS NULL THEN mined END AS mined, CASE WHEN listed IS NULL THEN confidence END AS confidence
FROM b LEFT JOIN a USING (tokens)
"""


CHAT = f"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM t),
p AS (SELECT conv_id, place, list([role, text]) OVER (PARTITION BY conv_id ORDER BY place) AS prefix FROM n),
w AS (SELECT conv_id, max(place) AS n_turns, arg_max(prefix, place) AS whole FROM p GROUP BY conv_id),
f AS (SELECT min(conv_id) AS conv_id, n_turns, whole, count(*) AS copies FROM w GROUP BY n_turns, whole),
i AS (SELECT DISTINCT prefix FROM p JOIN w USING (conv_id) WHERE place < n_turns),
m AS (SELECT conv_id, n_turns, copies FROM f WHERE whole NOT IN (SELECT prefix FROM i))
SELECT m.conv_id, ((place - 1) // {TURNS_PER_PART})::BIGINT AS part, any_value(n_turns)::BIGINT AS n_turns,
  any_value(copies)::BIGINT AS copies,
  string_agg('<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10),
             '' ORDER BY place) AS text
FROM m JOIN n ON n.conv_id = m.conv_id GROUP BY m.conv_id, (place - 1) // {TURNS_PER_PART}
"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i
      FROM (SELECT r, regexp_extract_all(text, '{WORD}') AS words FROM d)),
g AS (SELECT *, lag(word) OVER p AS before,
        CASE WHEN lead(word, 4) OVER p IS NOT NULL THEN
          [word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p] END AS gram
      FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
k AS (SELECT *, gram IS NOT NULL AND count(*) OVER (PARTITION BY r, gram) > 1 AS again FROM g),
c AS (SELECT *, max(again::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM k),
a AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(inside) AS n_repeat_words,
        count(*) FILTER (word = before) AS same FROM c GROUP BY r),
l AS (SELECT r, count(*) AS lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{WORD}') GROUP BY r),
s AS (SELECT r, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS upper,
        length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS lower,
        length(text) - length(replace(text, '!', '')) AS marks,
        strlen(text) - length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS beyond,
        strlen(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS solid,
        strlen(regexp_replace(text, '[\x20-\x40\x5B-\x60\x7B-\x7F\x00-\x1F]', '', 'g')) AS letters,
        length(text) - length(replace(text, chr(10), '')) AS breaks FROM d),
f AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        n_symbols::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(same, 0) AS same, coalesce(lines, 0) AS lines,
        upper, lower, marks, solid, letters, breaks
      FROM d JOIN s USING (r) LEFT JOIN a USING (r) LEFT JOIN l USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR upper > lower OR 5 * marks > n_words OR 5 * same > n_words
       OR breaks >= 5 AND lines >= 6 AND 3 * n_dup_lines > lines OR 2 * letters < solid) AS kept
FROM b
"""

#: The table of the CRC-32 of the polynomial 0xEDB88320.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i))"""


def crc32(digits: str) -> str:
    """The CRC-32 of bytes given as a list of hex pairs, with crc_table in scope."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({digits}, lambda h: ('0x' || h)::BIGINT)), "
            "lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)::BIGINT")


SHARDS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size, sha256(coalesce(text, '')) AS key,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS digits FROM documents),
{CRC_TABLE},
g AS (SELECT key, sum(size)::BIGINT AS load, min(doc_id) AS tie FROM d GROUP BY key),
o AS (SELECT *, row_number() OVER (ORDER BY load DESC, tie, key) AS i FROM g),
s AS (
  SELECT 0::BIGINT AS i, ''::VARCHAR AS key, -1 AS shard, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[] AS loads
  UNION ALL
  SELECT o.i, o.key, list_position(loads, list_min(loads)) - 1,
    list_transform(loads, lambda x, n: CASE WHEN n = list_position(loads, list_min(loads)) THEN x + o.load ELSE x END)
  FROM s JOIN o ON o.i = s.i + 1)
SELECT doc_id, size,
  {crc32("digits")} AS text_crc32,
  'bytes' AS law, shard::INT AS shard,
  ({rank_sql('shard', 'doc_id, key', '(SELECT count(*) FROM d)')})::BIGINT AS slot, NULL::INT AS grown_shard
FROM d JOIN s USING (key) CROSS JOIN crc_table
"""

MIX = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source FROM documents),
c AS (SELECT source, count(*) AS n FROM d GROUP BY source),
a AS (SELECT *, n ** {TEMPER} / sum(n ** {TEMPER}) OVER () AS share, min(n ** {TEMPER}) OVER () / sum(n ** {TEMPER}) OVER () AS low FROM c),
e AS (SELECT source, n, share, greatest({PERIOD}, 10 * count(*) OVER (), round_even(
        least({LONGEST_PERIOD}, greatest(1, least({FAIR_SLOTS}, floor({LONGEST_PERIOD} * low))) / low), 0)::BIGINT) AS period FROM a),
q AS (SELECT *, greatest(1, floor(period * share))::BIGINT AS low, period * share AS exact FROM e),
z AS (SELECT *, low + (row_number() OVER (ORDER BY low - exact, source) <= period - sum(low) OVER ())::BIGINT AS per,
        row_number() OVER (ORDER BY source) AS s FROM q),
v AS (SELECT list(per ORDER BY s) AS pers, any_value(period)::BIGINT AS period FROM z),
x AS (
  SELECT 0::BIGINT AS t, list_transform(pers, lambda p: 0::BIGINT) AS done, [0, 0, 0, 0]::BIGINT[] AS pick FROM v
  UNION ALL
  SELECT t + 1, list_transform(done, lambda k, i: k + (i = best[2])::BIGINT), best
  FROM (SELECT t, done, list_min(list_filter(list_transform(done, lambda k, i:
          CASE WHEN k < pers[i] AND k * period // pers[i] <= t
               THEN [-(-(k + 1) * period // pers[i] - ((k + 1) * period % pers[i] > 0)::BIGINT), i, k, k * period // pers[i]] END),
          lambda y: y IS NOT NULL)) AS best FROM x, v WHERE t < period)),
k AS (SELECT t - 1 AS t, pick[1] AS deadline, pick[2] AS s, pick[3] AS k, pick[4] AS release FROM x WHERE t > 0),
r AS (SELECT doc_id, source, s, per, n, period::BIGINT AS period,
        {rank_sql('source', 'doc_id', '(SELECT count(*) FROM d)')} AS rank FROM d JOIN z USING (source)),
h AS (SELECT max((((n + {BLOCK_ROWS} - 1) // {BLOCK_ROWS} - 1) // per) * period + t) + 1 AS stop
      FROM z JOIN k ON k.s = z.s AND k.k = ((n + {BLOCK_ROWS} - 1) // {BLOCK_ROWS} - 1) % per),
u AS (SELECT r.*, stop, unnest(range(0, ((ceil(stop / period)::BIGINT * per * {BLOCK_ROWS} - 1 - rank) // n) + 1)) AS epoch FROM r, h),
b AS (SELECT *, rank + epoch * n AS place, (rank + epoch * n) // {BLOCK_ROWS} AS block FROM u)
SELECT doc_id, source, epoch::BIGINT AS epoch, block::BIGINT AS block,
  (block // per * period + release)::BIGINT AS release, (block // per * period + deadline)::BIGINT AS deadline,
  (block // per * period + t)::BIGINT AS slot,
  ((block // per * period + t) * {BLOCK_ROWS} + place % {BLOCK_ROWS})::BIGINT AS position
FROM b JOIN k ON k.s = b.s AND k.k = block % per WHERE block // per * period + t < stop
"""


def packing_sql() -> str:
    """The best last bucket for every number of buckets and every bound, then the bounds back from the last."""
    levels = ["c1 AS (SELECT j, len, len * total AS cost, NULL::BIGINT AS cut FROM h)"]
    for k in range(2, BUCKETS + 1):
        levels.append(f"""
c{k} AS (SELECT p.j, p.len, least(p.cost, m.cost) AS cost, CASE WHEN m.cost < p.cost THEN m.i END AS cut
  FROM c{k - 1} p LEFT JOIN (
    SELECT b.j, min(a.cost + b.len * (b.total - x.total)) AS cost, arg_min(a.j, (a.cost + b.len * (b.total - x.total), a.j)) AS i
    FROM c{k - 1} a JOIN h x ON x.j = a.j JOIN h b ON b.j > a.j GROUP BY b.j) m ON m.j = p.j)""")
    walk = [f"w{BUCKETS} AS (SELECT max(j) AS j FROM h)"]
    for k in range(BUCKETS - 1, 0, -1):
        walk.append(f"w{k} AS (SELECT coalesce(c.cut, w.j) AS j FROM w{k + 1} w JOIN c{k + 1} c ON c.j = w.j)")
    bounds = " UNION ".join(f"SELECT j FROM w{k}" for k in range(1, BUCKETS + 1))
    room = MAX_LENGTH - 1
    return f"""
WITH d AS (SELECT doc_id, length(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n FROM documents),
q AS (SELECT doc_id, chunk, least({room}, n - chunk * {room}) + 1 AS length
      FROM (SELECT *, unnest(range(greatest(1, (n + {room - 1}) // {room}))) AS chunk FROM d)),
h AS (SELECT length AS len, row_number() OVER (ORDER BY length) AS j,
        (sum(count(*)) OVER (ORDER BY length))::BIGINT AS total FROM q GROUP BY length),
{", ".join(levels)},
{", ".join(walk)},
b AS (SELECT len AS bound, row_number() OVER (ORDER BY len) - 1 AS bucket FROM h WHERE j IN ({bounds})),
s AS (SELECT q.*, min(b.bucket) AS bucket, min(b.bound) AS bound FROM q JOIN b ON b.bound >= q.length GROUP BY ALL),
r AS (SELECT *, {rank_sql('bucket', 'doc_id, chunk', '(SELECT count(*) FROM q)')} AS rank FROM s)
SELECT doc_id, chunk::BIGINT AS chunk, length::BIGINT AS length, bucket::INT AS bucket, bound::BIGINT AS bound,
  (bound - length)::BIGINT AS padding, (rank // ({BUDGET} // bound))::BIGINT AS batch, (rank % ({BUDGET} // bound))::BIGINT AS slot
FROM r
"""


def top_k_sql() -> str:
    """Every pair of query and candidate; whole numbers stay exact as doubles at these sizes."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor({topk.SCALE} * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM p
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= {topk.NEAREST}
"""


def resampling_sql(how: Resampling = Resampling()) -> str:
    """For runs of one word."""
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    b = how.buckets
    return f"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
w AS (SELECT r, unnest(words) AS word FROM d),
y AS (SELECT unnest({words}) AS word FROM benchmark),
k AS (SELECT word, {crc32("regexp_extract_all(hex(encode(word)), '..')")} % {b} AS bucket
      FROM (SELECT word FROM w UNION SELECT word FROM y) CROSS JOIN crc_table),
s AS (SELECT bucket, count(*) AS s FROM w JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM y JOIN k USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(
        ((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM w) + {b}))
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM y) + {b}))))::BIGINT AS gain
      FROM (SELECT DISTINCT bucket FROM k) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
m AS (SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM w JOIN k USING (word) JOIN g USING (bucket) GROUP BY r),
f AS (SELECT r, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{how.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
          + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM d LEFT JOIN m USING (r)),
e AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM f WHERE n_features >= {how.min_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * {how.percent} // 100 THEN rank END::BIGINT AS rank
FROM f LEFT JOIN e USING (r)
"""


ORACLES: dict[str, str] = {
    "op1_url_rules": url_sql(),
    "op3_pfair_mix": MIX,
    "op6_quality_cascade": QUALITY,
    "op8_length_buckets": packing_sql(),
    "op9_lpt_shards": SHARDS,
    "op10_chat_snapshots": CHAT,
    "op11_mtree_topk": top_k_sql(),
    "op13_importance_resampling": resampling_sql(),
}
