"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from kelvibra.llm import settings as S

OP4 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)"""


def _rule_when(value: int) -> str:
    order = sorted(S.URL_RULES, key=lambda r: -len(r[1] + r[2]))
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN "
        f"'{(verdict, h + p)[value]}'" for verdict, h, p in order) + " END"


OP9 = f"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
             FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, {_rule_when(1)} AS rule,
       coalesce({_rule_when(0)}, CASE WHEN regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) IN
                ({', '.join(f"'{d}'" for d in S.LISTED_DOMAINS)}) THEN 'block' ELSE 'allow' END) AS verdict
FROM split"""

OP11 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
                                                   lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
          FROM words, unnest([1, 2, 3, 4, 5]) AS s(size) WHERE len(w) >= size),
counts AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
cuts AS (SELECT c.lang, c.phrase, c.size, c.a, k, c.w[1:k] AS x, c.w[k + 1:] AS y
         FROM candidates AS c, unnest([1, 2, 3, 4]) AS s(k) WHERE k < size),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, k, p.a AS l, q.a AS r, n,
                  ((1000::HUGEINT * cuts.a * n) // (p.a::HUGEINT * q.a))::BIGINT AS score
           FROM cuts JOIN counts AS p ON p.lang = cuts.lang AND p.phrase = array_to_string(x, ' ')
           JOIN counts AS q ON q.lang = cuts.lang AND q.phrase = array_to_string(y, ' ')
           JOIN totals AS t ON t.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (SELECT lang, a, array_to_string(w[i:j], ' ') AS phrase
                  FROM candidates, unnest([1, 2, 3, 4]) AS s(i), unnest([2, 3, 4, 5]) AS e(j)
                  WHERE i < j AND j <= size AND j - i + 1 < size),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000"""


def build() -> dict[str, str]:
    found = {"op4_exact_stream": OP4, "op9_url_cascade": OP9, "op11_prefix_free_phrases": OP11,
             "pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: v for k, v in found.items() if v is not None}
