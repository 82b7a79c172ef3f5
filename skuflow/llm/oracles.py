"""DuckDB SQL for the operators whose results plain SQL can give: licenses, mixing, near duplicates."""

from __future__ import annotations

import string

from skuflow.llm import jaccard, licenses, mixing

_LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _strings(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _places(phrase: str) -> str:
    words = phrase.split()
    hit = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(words))
    return f"list_filter(range(0, len(w) - {len(words) - 1}), lambda i: {hit})"


def license_sql(templates: dict[str, list[str]] | None = None, threshold: float = 0.8) -> str:
    """Phrase places by list functions; every block against every template by their intersection."""
    half, block = licenses.MAX_TEMPLATE_WORDS, licenses.BLOCK_WORDS
    sets = licenses._template_sets(licenses.TEMPLATES if templates is None else templates, threshold)
    rows = ", ".join(f"({n}, '{label}', {_strings(toks)}, {need})" for n, (label, toks, need) in enumerate(sets))
    places = ", ".join(f"{_places(p)} AS p{i}" for i, p in enumerate(licenses.PHRASES))
    every = " || ".join(f"p{i}" for i in range(len(licenses.PHRASES)))
    base = " || ".join(f"CASE WHEN len(p{i}) > 0 THEN ['{label}'] ELSE [] END" for i, label in enumerate(licenses.PHRASES.values()))
    return rf"""
    WITH m AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    found AS (SELECT r, doc_id, len(w) AS n_words, {places} FROM m),
    base AS (SELECT r, doc_id, n_words, {every} AS places, {base} AS labels FROM found),
    blocks AS (SELECT r, b, list_distinct(w[{half} * b + 1:{half} * b + {block}]) AS held
               FROM (SELECT r, w, unnest(range(0, 1 + greatest(0, ceil((len(w) - {block}) / {half}))::BIGINT)) AS b FROM m)),
    templates(template, label, toks, need) AS (VALUES {rows}),
    hits AS (SELECT r, label, len(list_intersect(held, toks)) / len(toks) AS score FROM blocks, templates
             WHERE len(list_intersect(held, toks)) >= need),
    method AS (SELECT r, list(DISTINCT label) AS more, max(score) AS top, count(*) AS n_blocks FROM hits GROUP BY r)
    SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base,
           list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
           array_to_string(list_sort(labels), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(labels || coalesce(more, []))), ',') AS labels,
           CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(top, 0.0)::DOUBLE END AS score,
           coalesce(n_blocks, 0)::BIGINT AS n_blocks
    FROM base LEFT JOIN method USING (r)
"""


def mix_sql(weights: tuple = (5, 2, 1), max_epochs: float = 3.0, seed: int = 17) -> str:
    """Water level over the sources by fill level; a source's extra repetition by a running sum in hash order."""
    return rf"""
    WITH m AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               ('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, {mixing.HASH_DIGITS}))::BIGINT AS h
        FROM documents),
    sized AS (SELECT source, sum(size)::BIGINT AS source_size FROM m GROUP BY source),
    weighed AS (SELECT *, [{", ".join(map(str, weights))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}] AS weight,
                source_size * {max_epochs}::DOUBLE AS cap FROM sized),
    levels AS (SELECT *, cap / weight AS level FROM weighed),
    filling AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS reached
                FROM levels WINDOW before AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    filled AS (SELECT *, CASE WHEN reached >= level THEN cap ELSE max(CASE WHEN reached < level THEN reached END) OVER () * weight END AS target FROM filling),
    quotas AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM filled),
    dealt AS (
        SELECT m.*, q.source_size, q.target, q.whole, greatest(0, round(q.target)::BIGINT - q.whole * q.source_size) AS quota,
               sum(size) OVER (PARTITION BY m.source ORDER BY h, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
        FROM m JOIN quotas q ON m.source IS NOT DISTINCT FROM q.source),
    extra AS (SELECT *, greatest(0, least(size, quota - upto + size)) AS extra FROM dealt)
    SELECT doc_id, source, size, source_size, target, (whole + CASE WHEN extra = size AND size > 0 THEN 1 ELSE 0 END)::BIGINT AS repeats,
           (whole * size + extra)::BIGINT AS taken
    FROM extra
"""


def jaccard_sql(threshold: float = jaccard.THRESHOLD, n: int = jaccard.NGRAM) -> str:
    """All pairs that share an n-gram, their similarity, and the classes by recursion."""
    return rf"""
    WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
    sets AS (SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) END)) AS grams FROM m),
    keyed AS (SELECT r, doc_id, md5(array_to_string(grams, chr(10))) AS node, len(grams) AS n, grams FROM sets),
    nodes AS (SELECT node, any_value(n) AS n, any_value(grams) AS grams, count(*) AS copies, min(doc_id) AS least FROM keyed GROUP BY node),
    held AS (SELECT node, unnest(grams) AS gram FROM nodes),
    common AS (SELECT a.node AS a, b.node AS b, count(*) AS c FROM held a JOIN held b ON a.gram = b.gram AND a.node <> b.node GROUP BY a.node, b.node),
    links AS (SELECT a, b, y.copies FROM common JOIN nodes x ON x.node = a JOIN nodes y ON y.node = b
              WHERE c * (1 + {threshold}) >= {threshold} * (x.n + y.n) - 1e-6),
    reach(node, other) AS (SELECT node, node FROM nodes UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
    classes AS (SELECT reach.node, min(least) AS class_id, sum(copies) AS class_size FROM reach JOIN nodes ON nodes.node = reach.other GROUP BY reach.node),
    counts AS (SELECT a AS node, sum(copies) AS n FROM links GROUP BY a)
    SELECT doc_id, class_id, (coalesce(counts.n, 0) + nodes.copies - 1)::BIGINT AS n_links, class_size::BIGINT AS class_size, keyed.n::BIGINT AS n_ngrams
    FROM keyed JOIN nodes USING (node) JOIN classes USING (node) LEFT JOIN counts USING (node)
"""
