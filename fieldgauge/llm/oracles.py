"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from fieldgauge.llm.importance import BUCKETS, DRAW_PERCENT, MIN_WORDS, SEED
from fieldgauge.llm.mixing import FLATTENING, KEEP_SHARE, MAX_SWEEPS

DECONTAMINATE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len(ws[s:s + 9]) AS m, array_to_string(ws[s:s + 9], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM items WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
places AS (
  SELECT doc_id, s, m, array_to_string(ws[s:s + m - 1], ' ') AS w
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS s FROM docs, lengths)),
found AS (SELECT doc_id, s, m, item_id FROM places JOIN windows USING (m, w)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _mix_sql(relation: str = "documents") -> str:
    """The raking as a chain of materialised steps; the budget constant in closed form."""
    dimensions = list(FLATTENING)
    cell = ", ".join(dimensions)
    steps = [
        rf"""named AS MATERIALIZED (
  SELECT *, CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '!!') THEN 'shout' WHEN contains(text, '%%%') THEN 'symbols'
              WHEN contains(text, 'License') OR contains(text, 'rights reserved') THEN 'notice' ELSE 'prose' END AS topic,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens
  FROM {relation})""",
        f"cells AS MATERIALIZED (SELECT {cell}, CAST(sum(tokens) AS BIGINT) AS tokens FROM named GROUP BY ALL)",
        "mass AS (SELECT CAST(sum(tokens) AS DOUBLE) AS m FROM cells)",
    ]
    for d, power in FLATTENING.items():
        steps.append(f"flat_{d} AS (SELECT {d}, CASE WHEN sum(tokens) > 0 THEN pow(CAST(sum(tokens) AS DOUBLE), {power}) ELSE 0 END AS p FROM cells GROUP BY {d})")
        steps.append(f"target_{d} AS MATERIALIZED (SELECT {d}, p / (SELECT sum(p) FROM flat_{d}) * m AS t FROM flat_{d}, mass)")
    joins = " ".join(f"JOIN target_{d} ON cells.{d} IS NOT DISTINCT FROM target_{d}.{d}" for d in dimensions)
    targets = ", ".join(f"target_{d}.t AS t_{d}" for d in dimensions)
    steps.append(f"w0 AS MATERIALIZED (SELECT cells.*, CAST(tokens AS DOUBLE) AS w, {targets} FROM cells {joins})")
    n = 0
    for _ in range(MAX_SWEEPS):
        for d in dimensions:
            steps.append(f"w{n + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {d}) > 0 THEN w * t_{d} / sum(w) OVER (PARTITION BY {d}) ELSE 0 END AS w) FROM w{n})")
            n += 1
    steps += [
        f"rated AS MATERIALIZED (SELECT {cell}, tokens, w, CASE WHEN tokens > 0 THEN w / tokens ELSE 1 END AS ratio FROM w{n})",
        f"""scales AS (
  SELECT ratio, ({KEEP_SHARE} * m - (sum(tokens) OVER o - tokens)) / (m - (sum(w) OVER o - w)) AS scale
  FROM rated, mass WHERE tokens > 0 WINDOW o AS (ORDER BY ratio DESC, {cell}))""",
        "scale AS (SELECT min_by(scale, -ratio) AS c FROM scales WHERE scale * ratio < 1)",
        f"chances AS MATERIALIZED (SELECT {cell}, ratio, least(1, ratio * coalesce(c, {KEEP_SHARE})) AS chance FROM rated, scale)",
    ]
    same = " AND ".join(f"named.{d} IS NOT DISTINCT FROM chances.{d}" for d in dimensions)
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, named.source, named.lang, named.topic, named.tokens, round(ratio, 6) AS ratio, round(chance, 6) AS chance,
       CAST(CAST(concat('0x', substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0 < chance AS INTEGER) AS kept
FROM named JOIN chances ON {same}
"""


RESAMPLE = rf"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents),
items AS MATERIALIZED (
  SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
in_docs AS MATERIALIZED (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS f FROM docs) GROUP BY ALL),
in_items AS MATERIALIZED (SELECT f, count(*) AS n FROM (SELECT unnest(ws) AS f FROM items) GROUP BY ALL),
crc_table AS (
  SELECT list(c ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
buckets AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT f, list_transform(range(CAST(len(hex(f)) // 2 AS BIGINT)), lambda i: CAST(concat('0x', substr(hex(f), 2 * i + 1, 2)) AS BIGINT)) AS bytes
        FROM (SELECT f FROM in_docs UNION SELECT f FROM in_items)), crc_table),
s AS (SELECT bucket, sum(n) AS s FROM in_docs JOIN buckets USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM in_items JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS all_s, coalesce((SELECT sum(t) FROM t), 0) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + {BUCKETS}) AS DOUBLE) / CAST((s + 1) * (all_t + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
sums AS (SELECT doc_id, sum(n * gain) AS total FROM in_docs JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(CASE WHEN len(ws) = 0 THEN 0 ELSE (total - ((total % len(ws)) + len(ws)) % len(ws)) / len(ws) END AS BIGINT) AS weight,
         CAST(concat('0x', substr(sha256(concat('{SEED}:', doc_id)), 1, 8)) AS BIGINT) AS h
  FROM docs LEFT JOIN sums USING (doc_id)),
noisy AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM noisy WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {DRAW_PERCENT} * n // 100 THEN place END AS rank
FROM noisy LEFT JOIN ranked USING (doc_id)
"""

LLM_ORACLES = {"op5_decontaminate": DECONTAMINATE, "op9_mix": _mix_sql(), "op11_resample": RESAMPLE}
