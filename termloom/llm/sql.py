"""SQL that must return the rows of those queries that SQL can express."""

from termloom.llm.common import WORD
from termloom.llm.mixing import MARGINALS, Mix
from termloom.llm.quality import SHARES, Risk


def _quality() -> str:
    risk = Risk()
    p = risk.alpha / len(risk.grids)
    grid = ", ".join(f"('{r}', {c}::DOUBLE)" for r, g in risk.grids.items() for c in g)
    share = " ".join(
        f"WHEN '{r}' THEN {a}::DOUBLE / greatest({b}, 1)" for r, (a, b) in SHARES.items()
    )
    broken = ", ".join(
        f"CASE WHEN {a}::DOUBLE / greatest({b}, 1) > c.{r} THEN '{r}' END"
        for r, (a, b) in SHARES.items()
    )
    limits = ", ".join(f"max(cutoff) FILTER (rule = '{r}') AS {r}" for r in SHARES)
    return f"""
WITH split AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS p FROM split)),
covered AS (
  SELECT doc_id, count(DISTINCT p + d) AS n
  FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) AS found,
       (VALUES (0), (1), (2)) AS offsets(d)
  WHERE found.n >= 2 GROUP BY doc_id),
features AS (
  SELECT s.doc_id, lang, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(lines)::BIGINT AS n_lines,
         length(regexp_replace(text, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split AS s LEFT JOIN covered AS c ON s.doc_id = c.doc_id),
base AS (
  SELECT *, n_words < {risk.min_words} OR 100 * n_repeat_words > {risk.max_repeat_percent} * n_words
            AS base_failed
  FROM features),
worst AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT lang, rule, cutoff, count(*) FILTER (quality >= 1) AS n,
         count(*) FILTER (quality >= 1 AND above) AS x,
         count(*) FILTER (quality < 1 AND above) AS bad
  FROM (SELECT lang, quality, rule, cutoff, CASE rule {share} END > cutoff AS above
        FROM base JOIN worst USING (doc_id), (VALUES {grid}) AS g(rule, cutoff)
        WHERE NOT base_failed)
  GROUP BY ALL),
proven AS (
  SELECT *, row_number() OVER (PARTITION BY lang, rule ORDER BY bad - x DESC, cutoff DESC) AS r
  FROM (SELECT *, list_sum(list_transform(range(0, x + 1), lambda i: exp(
            lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
            + i * ln({p}::DOUBLE) + (n - i) * ln(1 - {p}::DOUBLE)))) AS tail
        FROM counted WHERE x <= {p} * n AND bad > x)
  WHERE tail <= {risk.delta} / (SELECT count(*) FROM (SELECT DISTINCT lang, rule FROM counted))),
cutoffs AS (SELECT lang, {limits} FROM proven WHERE r = 1 GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM (SELECT b.*, concat_ws(',', {broken}) AS failed_rules
      FROM base AS b LEFT JOIN cutoffs AS c ON b.lang IS NOT DISTINCT FROM c.lang)
"""


def _mixing() -> str:
    mix = Mix()
    steps, last = [], "raked_0"
    steps.append("raked_0 AS MATERIALIZED (SELECT *, tokens AS weight FROM cells)")
    for k in range(mix.sweeps * len(MARGINALS)):
        m = MARGINALS[k % len(MARGINALS)]
        steps.append(
            f"""raked_{k + 1} AS MATERIALIZED (
  SELECT source, lang, topic, tokens, CASE WHEN now > 0 THEN weight * goal / now ELSE 0 END AS weight
  FROM (SELECT *, sum(weight) OVER (PARTITION BY {m}) AS now FROM {last})
  JOIN goal_{m} ON {m} = value)"""
        )
        last = f"raked_{k + 1}"
    goals = ",\n".join(
        f"""goal_{m} AS MATERIALIZED (
  SELECT value, p / sum(p) OVER () * (SELECT sum(tokens) FROM cells) AS goal
  FROM (SELECT {m} AS value, pow(sum(tokens), {mix.flatten}) AS p FROM cells GROUP BY {m}))"""
        for m in MARGINALS
    )
    return f"""
WITH measured AS MATERIALIZED (
  SELECT doc_id, source, lang,
         CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '###') THEN 'symbols'
              WHEN contains(text, '@') THEN 'contact' WHEN contains(text, 'icense') THEN 'legal'
              WHEN length(text) < 1000 THEN 'short' ELSE 'long' END AS topic,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents)),
cells AS MATERIALIZED (
  SELECT coalesce(source, '') AS source, coalesce(lang, '') AS lang, topic,
         sum(n_tokens)::DOUBLE AS tokens
  FROM measured GROUP BY ALL),
{goals},
{",\n".join(steps)},
rates AS MATERIALIZED (
  SELECT *, weight / tokens AS rate,
         sum(tokens) OVER () * {mix.fraction} AS budget, sum(weight) OVER () AS total,
         coalesce(sum(tokens) OVER above, 0) AS full_tokens,
         coalesce(sum(weight) OVER above, 0) AS full_weight
  FROM {last} WHERE tokens > 0
  WINDOW above AS (ORDER BY weight / tokens DESC, source, lang, topic
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
factor AS (
  SELECT (budget - full_tokens) / (total - full_weight) AS factor
  FROM rates WHERE (budget - full_tokens) / (total - full_weight) * rate < 1
  ORDER BY rate DESC, source, lang, topic LIMIT 1)
SELECT doc_id, m.source, m.lang, m.topic, n_tokens, round(coalesce(rate, 0), 6) AS weight,
       round(least(1, coalesce(rate, 0) * factor), 6) AS probability,
       ('0x' || substr(md5('{mix.seed}:' || doc_id), 1, 8))::BIGINT / 4294967296.0
           < least(1, coalesce(rate, 0) * factor) AS taken
FROM measured AS m CROSS JOIN factor
LEFT JOIN rates AS r ON coalesce(m.source, '') = r.source AND coalesce(m.lang, '') = r.lang
                    AND m.topic = r.topic
"""


TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors AS q, vectors AS c
  WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP3 = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE c.n >= 0.8 * (x.n + y.n - c.n)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM texts
    UNION SELECT r.doc_id, w.b FROM reached r JOIN ways w ON w.a = r.other),
classes AS (SELECT doc_id, min(other) AS class_id, count(*) AS class_size FROM reached GROUP BY doc_id)
SELECT doc_id, class_id, class_size, doc_id = class_id AS kept FROM classes
"""

OP4 = f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
    SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS name
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM texts WHERE len(w) >= 35)),
again AS (SELECT name FROM windows GROUP BY name HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 35)) AS pos FROM windows SEMI JOIN again USING (name)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM texts),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
    FROM words ANTI JOIN gone USING (r, pos) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

ORACLE_SQL = {
    "op3_minhash_dedup": OP3,
    "op4_substring_dedup": OP4,
    "op8_mixing": _mixing(),
    "op9_topk": TOP_K,
    "op10_quality_rules": _quality(),
}
