"""Common table expressions for the SQL that checks the registered queries."""

import re

from termloom.functions.stemmer import IRREGULAR, STEP_2, STEP_3, STEP_4
from termloom.functions.text import BUILD_PATTERN, QUERY_PATTERN
from termloom.functions.words import BUILD_STOPWORDS, QUERY_STOPWORDS
from termloom.inventory.corpus import TRUTH_WORDS
from termloom.plans.build import MIN_DF
from termloom.plans.evaluate import DEPTH, EVALUATION_PAIRS
from termloom.plans.search import MAX_PAIRS, MAX_RESULTS
from termloom.sources.tables import LINK_PATTERN


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


BUILD = text(BUILD_PATTERN)
QUERY = text(QUERY_PATTERN)
LINK = text(LINK_PATTERN)
BUILD_STOP = words(BUILD_STOPWORDS)
QUERY_STOP = words(QUERY_STOPWORDS)
UNION_STOP = "(VALUES " + ", ".join(f"({text(w)})" for w in BUILD_STOPWORDS) + ")"


def _stems(source: str) -> str:
    """``term, stem`` of the words of ``source``: Porter's steps as nested selects over word and shape."""

    def head(value: str, less: int) -> str:
        return f"left({value}, length({value}) - {less})" if less else value

    def measure(less: int, of: str = "s") -> str:
        return f"len(regexp_extract_all({head(of, less)}, 'vc'))"

    def short(less: int) -> str:
        left, word = head("s", less), head("w", less)
        return f"(({left} LIKE '%cvc' AND NOT regexp_matches({word}, '[wxy]$')) OR {left} = 'vc')"

    def suffixes(rules, value) -> str:
        return "CASE " + " ".join(f"WHEN suffix(w, '{rule[0]}') THEN {value(*rule)}" for rule in rules) + " ELSE w END"

    def replaced(suffix: str, new: str) -> str:
        return f"CASE WHEN {measure(len(suffix))} > 0 THEN {head('w', len(suffix))} || '{new}' ELSE w END"

    def dropped(suffix: str) -> str:
        also = " AND regexp_matches(w, '[st]ion$')" if suffix == "ion" else ""
        return f"CASE WHEN {measure(len(suffix))} > 1{also} THEN {head('w', len(suffix))} ELSE w END"

    def repaired(less: int) -> str:
        stem, twice = head("w", less), f"right({head('w', less)}, 1) = left(right({head('w', less)}, 2), 1)"
        return f"""CASE WHEN regexp_matches({stem}, '(at|bl|iz)$') THEN {stem} || 'e'
            WHEN length({stem}) > 1 AND {twice} AND {head("s", less)} LIKE '%c'
                THEN CASE WHEN regexp_matches({stem}, '[lsz]$') THEN {stem} ELSE {head("w", less + 1)} END
            WHEN {measure(less)} = 1 AND {short(less)} THEN {stem} || 'e' ELSE {stem} END"""

    ie = "CASE WHEN length(w) = 4 THEN {0} ELSE {1} END".format(head("w", 1), head("w", 2))
    steps = [
        f"""CASE WHEN suffix(w, 'ies') THEN {ie} WHEN suffix(w, 'sses') THEN {head("w", 2)}
            WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN {head("w", 1)} ELSE w END""",
        f"""CASE WHEN suffix(w, 'ied') THEN {ie}
            WHEN suffix(w, 'eed') THEN CASE WHEN {measure(3)} > 0 THEN {head("w", 1)} ELSE w END
            WHEN suffix(w, 'ed') AND contains({head("s", 2)}, 'v') THEN {repaired(2)}
            WHEN suffix(w, 'ing') AND contains({head("s", 3)}, 'v') THEN {repaired(3)} ELSE w END""",
        f"""CASE WHEN suffix(w, 'y') AND length(w) > 2 AND {head("s", 1)} LIKE '%c' THEN {head("w", 1)} || 'i' ELSE w END""",
        f"CASE WHEN suffix(w, 'alli') AND {measure(4)} > 0 THEN {head('w', 2)} ELSE w END",
        f"""CASE WHEN suffix(w, 'logi') THEN CASE WHEN {measure(3)} > 0 THEN {head("w", 1)} ELSE w END
            ELSE {suffixes(STEP_2, replaced)} END""",
        suffixes(STEP_3, replaced),
        suffixes([(x,) for x in STEP_4], dropped),
        f"""CASE WHEN suffix(w, 'e') AND ({measure(1)} > 1 OR ({measure(1)} = 1 AND NOT {short(1)}))
            THEN {head("w", 1)} ELSE w END""",
        f"CASE WHEN suffix(w, 'll') AND {measure(1)} > 1 THEN {head('w', 1)} ELSE w END",
    ]
    shaped = "translate(regexp_replace(w, '[^aeiouy]', 'c', 'g'), 'aeiou', 'vvvvv')"
    shaped = f"regexp_replace({shaped}, '(^|v)y', '\\1c', 'g')"
    shaped = f"replace(replace({shaped}, 'yy', 'vc'), 'y', 'v')"
    made = f"SELECT term, lower(term) AS w FROM {source}"
    for step in steps:
        made = f"SELECT term, {step} AS w FROM (SELECT term, w, {shaped} AS s FROM ({made}))"
    known = " ".join(f"WHEN '{word}' THEN '{stem}'" for word, stem in IRREGULAR.items())
    return f"""
        SELECT term, CASE lower(term) {known}
                     ELSE CASE WHEN length(term) <= 2 THEN lower(term) ELSE w END END AS stem
        FROM ({made})"""


def _ranking(
    prefix: str, vector: str, pairs: int, skip_zeros: bool, of: str = ""
) -> dict[str, str]:
    """The search ranking over a given query vector; ``of`` is put before the names of the index's tables."""
    zero = "weight = 0," if skip_zeros else ""
    return {
        f"{prefix}vector": f"""
            SELECT q.query_id, q.term, q.qtf, q.query_len, t.df,
                   row_number() OVER (PARTITION BY q.query_id ORDER BY q.term) AS term_no,
                   (q.qtf / q.query_len) * log10(n.n / (t.df + 1e-7)) AS weight
            FROM {vector} q JOIN {of}terms t USING (term) CROSS JOIN corpus n""",
        f"{prefix}q": f"""
            SELECT *, row_number() OVER (PARTITION BY query_id
                                         ORDER BY {zero} term) AS ord
            FROM {prefix}vector""",
        f"{prefix}pairs": f"""
            SELECT q.query_id, p.doc_id, p.term, q.term_no,
                   p.tf * log10(n.n / q.df) AS w
            FROM {prefix}q q JOIN {of}postings p USING (term) CROSS JOIN corpus n""",
        f"{prefix}candidates": f"""
            SELECT *, row_number() OVER (PARTITION BY query_id
                                         ORDER BY w DESC, term, doc_id) AS ck
            FROM {prefix}pairs QUALIFY ck <= {pairs}""",
        f"{prefix}sparse": f"""
            SELECT *, row_number() OVER (PARTITION BY query_id, doc_id
                                         ORDER BY ck) AS ord
            FROM {prefix}candidates WHERE w <> 0""",
        f"{prefix}by_place": f"""
            SELECT s.query_id, s.doc_id, coalesce(sum(q.weight * s.w), 0) AS dot,
                   count(*) AS coordination, min(s.ck) AS first_ck
            FROM {prefix}sparse s LEFT JOIN {prefix}q q USING (query_id, ord)
            GROUP BY s.query_id, s.doc_id""",
        f"{prefix}by_term": f"""
            SELECT s.query_id, s.doc_id, coalesce(sum(q.weight * s.w), 0) AS dot,
                   count(*) AS coordination, min(s.ck) AS first_ck
            FROM {prefix}sparse s LEFT JOIN {prefix}q q USING (query_id, term)
            GROUP BY s.query_id, s.doc_id""",
        f"{prefix}hits": f"""
            SELECT q.query_id, e.doc_id, sum(q.qtf)::BIGINT AS hits
            FROM {prefix}q q JOIN {of}title_entries e USING (term)
            GROUP BY q.query_id, e.doc_id""",
        f"{prefix}ranked": f"""
            SELECT query_id, doc_id, title, hits, score,
                   row_number() OVER (PARTITION BY query_id
                                      ORDER BY hits DESC, score DESC, first_ck) AS rank
            FROM (SELECT d.query_id, d.doc_id, t.title, coalesce(h.hits, 1) AS hits,
                         round(d.dot * d.coordination, 5) AS score, d.first_ck
                  FROM {prefix}by_place d
                  LEFT JOIN {prefix}hits h USING (query_id, doc_id)
                  LEFT JOIN titles t USING (doc_id))
            QUALIFY rank <= {MAX_RESULTS}""",
        f"{prefix}aligned_ranked": f"""
            SELECT query_id, doc_id, title, hits, score,
                   row_number() OVER (PARTITION BY query_id
                                      ORDER BY hits DESC, score DESC, first_ck) AS rank
            FROM (SELECT d.query_id, d.doc_id, t.title, coalesce(h.hits, 1) AS hits,
                         round(d.dot * d.coordination, 5) AS score, d.first_ck
                  FROM {prefix}by_term d
                  LEFT JOIN {prefix}hits h USING (query_id, doc_id)
                  LEFT JOIN titles t USING (doc_id))
            QUALIFY rank <= {MAX_RESULTS}""",
    }


PARTS = {
    "corpus": "SELECT count(*)::DOUBLE AS n FROM documents",
    "titles": """
        SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents""",
    "page_titles": """
        SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title
        FROM pages""",
    "tokens": f"""
        SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos
        FROM doc_words""",
    "entries": f"""
        SELECT term, doc_id, count(*) AS tf FROM tokens
        WHERE term NOT IN {BUILD_STOP} GROUP BY term, doc_id""",
    "all_terms": """
        SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total
        FROM entries GROUP BY term""",
    "terms": f"SELECT * FROM all_terms WHERE df > {MIN_DF}",
    "postings": "SELECT * FROM entries WHERE term IN (SELECT term FROM terms)",
    "words": """
        SELECT DISTINCT term FROM (SELECT term FROM entries UNION ALL SELECT term FROM title_entries
                                   UNION ALL SELECT term FROM query_tokens)""",
    "stems": _stems("words"),
    "stem_entries": """
        SELECT stem AS term, doc_id, sum(tf)::BIGINT AS tf
        FROM entries JOIN stems USING (term) GROUP BY stem, doc_id""",
    "stem_terms": f"""
        SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total
        FROM stem_entries GROUP BY term HAVING count(*) > {MIN_DF}""",
    "stem_postings": "SELECT * FROM stem_entries WHERE term IN (SELECT term FROM stem_terms)",
    "stem_title_entries": """
        SELECT stem AS term, doc_id, sum(tf)::BIGINT AS tf
        FROM title_entries JOIN stems USING (term) GROUP BY stem, doc_id""",
    "stem_query_terms": """
        SELECT query_id, stem AS term, sum(qtf)::BIGINT AS qtf, query_len
        FROM query_terms JOIN stems USING (term) GROUP BY query_id, stem, query_len""",
    "doc_lengths": """
        SELECT doc_id, sum(tf)::BIGINT AS doc_len FROM entries GROUP BY doc_id""",
    "title_entries": f"""
        SELECT term, doc_id, count(*) AS tf
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(title), {BUILD})) AS term
              FROM titles)
        WHERE term NOT IN {BUILD_STOP} GROUP BY term, doc_id""",
    "links": f"""
        SELECT unnest(regexp_extract_all(html, {LINK}, 1)) AS target,
               unnest(regexp_extract_all(html, {LINK}, 2)) AS anchor_text
        FROM pages""",
    "resolved_links": """
        SELECT regexp_replace(url, '#.*$', '') AS page, target AS href, anchor_text,
               regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) || target AS target
        FROM (SELECT url, unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1)) AS target,
                     unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2)) AS anchor_text
              FROM pages)""",
    "link_hits": f"""
        SELECT q.query_id, e.target AS doc_id, sum(q.qtf)::BIGINT AS hits
        FROM query_terms q JOIN (
            SELECT DISTINCT target, unnest(regexp_extract_all(lower(anchor_text), {BUILD})) AS term
            FROM resolved_links) e USING (term)
        WHERE e.term NOT IN {BUILD_STOP} GROUP BY q.query_id, e.target""",
    "anchor_entries": f"""
        SELECT term, target AS doc_id, count(*) AS tf
        FROM (SELECT target, unnest(regexp_extract_all(lower(anchor_text), {BUILD})) AS term
              FROM links)
        WHERE term NOT IN {BUILD_STOP} GROUP BY term, target""",
    "query_texts": """
        SELECT item_id AS query_id, text AS query_text FROM benchmark""",
    "query_tokens": f"""
        SELECT query_id, unnest(regexp_extract_all(lower(query_text), {QUERY})) AS term
        FROM query_texts""",
    "query_terms": f"""
        SELECT query_id, term, count(*) AS qtf,
               (sum(count(*)) OVER (PARTITION BY query_id))::BIGINT AS query_len
        FROM query_tokens WHERE term NOT IN {QUERY_STOP} GROUP BY query_id, term""",
    "doc_words": f"""
        SELECT doc_id, regexp_extract_all(lower(text), {BUILD}) AS w FROM documents""",
    "item_words": f"""
        SELECT item_id AS query_id, w, least(len(w), {TRUTH_WORDS}) AS n
        FROM (SELECT item_id, regexp_extract_all(lower(text), {BUILD}) AS w FROM benchmark)
        WHERE len(w) > 0""",
    "item_runs": """
        SELECT DISTINCT query_id, array_to_string(w[i + 1:i + n], ' ') AS run
        FROM (SELECT query_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM item_words)""",
    "runs": """
        SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + n], ' ') AS run
        FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i
              FROM doc_words, (SELECT DISTINCT n FROM item_words) WHERE len(w) >= n)""",
    "qrels": """
        SELECT DISTINCT query_id, query_text, doc_id
        FROM item_runs JOIN runs USING (run) JOIN query_texts USING (query_id)""",
    "ranks": "SELECT doc_id AS id, quality::DOUBLE AS rank FROM labels",
    "views": """
        SELECT user_id AS id, count(*) AS views FROM events
        WHERE event_type = 'view' GROUP BY user_id""",
    **_ranking("", "query_terms", MAX_PAIRS, True),
    **_ranking("stem_", "stem_query_terms", MAX_PAIRS, True, of="stem_"),
    "norm_pairs": """
        SELECT q.query_id, p.doc_id, p.term, (p.tf / l.doc_len) * log10(n.n / q.df) AS w
        FROM q JOIN postings p USING (term) JOIN doc_lengths l USING (doc_id)
        CROSS JOIN corpus n""",
    "cosines": """
        SELECT query_id, doc_id, score FROM (
            SELECT w.query_id, w.doc_id,
                   round(CASE WHEN sum(w.w * w.w) * max(v.norm2) > 0
                              THEN sum(q.weight * w.w)
                                   / sqrt(max(v.norm2) * sum(w.w * w.w)) END, 5) AS score
            FROM norm_pairs w JOIN q USING (query_id, term)
            JOIN (SELECT query_id, sum(weight * weight) AS norm2 FROM q
                  GROUP BY query_id) v USING (query_id)
            GROUP BY w.query_id, w.doc_id) WHERE score IS NOT NULL""",
    "title_hits": """
        SELECT q.query_id, e.doc_id, sum(q.qtf)::BIGINT AS hits
        FROM query_terms q JOIN title_entries e USING (term)
        GROUP BY q.query_id, e.doc_id""",
    "anchor_hits": """
        SELECT q.query_id, e.doc_id, sum(q.qtf)::BIGINT AS hits
        FROM query_terms q JOIN anchor_entries e USING (term)
        GROUP BY q.query_id, e.doc_id""",
    "eval_terms": f"""
        SELECT query_id, term, count(*) AS qtf,
               (sum(count(*)) OVER (PARTITION BY query_id))::BIGINT AS query_len
        FROM (SELECT DISTINCT query_id, query_text,
                     unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos
              FROM (SELECT DISTINCT query_id, query_text,
                           regexp_extract_all(lower(query_text), {BUILD}) AS w FROM qrels))
        WHERE term NOT IN {QUERY_STOP} GROUP BY query_id, term""",
    **_ranking("eval_", "eval_terms", EVALUATION_PAIRS, False),
    "marked": f"""
        SELECT p.query_id, p.rank, p.doc_id,
               (r.doc_id IS NOT NULL)::BIGINT AS hit
        FROM eval_ranked p
        LEFT JOIN (SELECT DISTINCT query_id, doc_id FROM qrels) r
            USING (query_id, doc_id)
        WHERE p.rank <= {DEPTH}""",
    "precisions": """
        SELECT query_id, rank, doc_id, hit_no / rank AS precision
        FROM (SELECT *, sum(hit) OVER (PARTITION BY query_id ORDER BY rank
                                       ROWS UNBOUNDED PRECEDING) AS hit_no FROM marked)
        WHERE hit = 1""",
    "average_precisions": """
        SELECT q.query_id, coalesce(n_hits, 0) AS n_hits,
               round(coalesce(mean, 0.0), 3) AS ap
        FROM (SELECT DISTINCT query_id FROM qrels) q
        LEFT JOIN (SELECT query_id, count(*) AS n_hits, avg(precision) AS mean
                   FROM precisions GROUP BY query_id) USING (query_id)""",
    "doc_requests": "SELECT doc_id // 10 AS req_id, doc_id % 10 AS pos, doc_id AS id FROM documents",
    "ranked_requests": "SELECT doc_id // 10 AS req_id, doc_id % 10 AS pos, doc_id AS id FROM labels",
    "customer_requests": "SELECT c_custkey // 10 AS req_id, c_custkey % 10 AS pos, c_custkey AS id FROM customer",
}


def _mentions(sql: str) -> list[str]:
    """The parts a piece of SQL reads, in the order of ``PARTS``."""
    named = set(re.findall(r"(?i)(?:FROM|JOIN)\s+(\w+)", sql))
    return [name for name in PARTS if name in named]


def complete(sql: str) -> str:
    """Put the parts that ``sql`` reads, and those they read, in front of it."""
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in _mentions(PARTS[name]):
                if other != name:
                    need(other)
            order.append(name)

    for name in _mentions(sql):
        need(name)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS MATERIALIZED (\n{PARTS[name].strip()}\n)" for name in order)
    return f"WITH {ctes}\n{sql.strip()}"
