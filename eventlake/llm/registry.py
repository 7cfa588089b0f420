"""The queries of this subpackage and the SQL that expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, divergence, exact_dedup, html_extract, near_dedup, phrases, quality, repeats, sentence_pieces, sharding, simhash, token_counts, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": html_extract.query,
        "op2_toxicity": toxicity.query,
        "op3_benchmark_decontamination": decontaminate.query,
        "op4_ngram_jaccard_join": near_dedup.query,
        "op5_sentencepiece": sentence_pieces.query,
        "op6_repeated_substrings": repeats.query,
        "op7_quality_classifier": quality.query,
        "op8_token_counts": token_counts.query,
        "op9_exact_dedup": exact_dedup.query,
        "op10_sharding": sharding.query,
        "op11_source_divergence": divergence.query,
        "op12_phrase_collocations": phrases.query,
        "op13_simhash": simhash.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": EXACT_DEDUP, "op11_source_divergence": DIVERGENCE, "op12_phrase_collocations": COLLOCATIONS}


EXACT_DEDUP = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS p, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY p DESC, doc_id)
"""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
             1 + 1000000000 * (k.n + 1) // (l.total + l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
m AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                 FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
      ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
t AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM m
      UNION ALL SELECT 'term', *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM t)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""

COLLOCATIONS = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws, i, unnest(range(1, least(6, len(ws) - i + 2))) AS k FROM s),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 100),
x AS (SELECT c.*, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS ws FROM c),
y AS (SELECT x.lang, x.phrase, x.k, x.a, x.cut, l.a AS l, r.a AS r, n.n, 1000 * x.a * n.n // (l.a * r.a) AS score,
             row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY 1000 * x.a * n.n // (l.a * r.a), x.cut) AS best
      FROM x JOIN n USING (lang) JOIN f l ON l.lang = x.lang AND l.k = x.cut AND l.phrase = array_to_string(x.ws[1:x.cut], ' ')
      JOIN f r ON r.lang = x.lang AND r.k = x.k - x.cut AND r.phrase = array_to_string(x.ws[x.cut + 1:], ' ')),
z AS (SELECT * FROM y WHERE best = 1 AND NOT EXISTS (FROM c WHERE c.lang = y.lang AND c.k > y.k AND 100 * c.a >= 100 * y.a
      AND contains(' ' || c.phrase || ' ', ' ' || y.phrase || ' '))),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM q WHERE rank <= 2000
"""
