"""DuckDB SQL for the queries of this package whose results SQL can express."""

PREFIX_TRIE = r"""
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         -- crc32 of the decimal text, bit by bit
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda c, bit: xor(c >> 1, 3988292384::BIGINT * (c & 1)))), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered)
), rebuilt AS (
  SELECT n.conv_id, place, role, text FROM numbered n JOIN ids ON ids.conv_id = n.conv_id WHERE place > h
  UNION ALL
  SELECT ids.conv_id, place, role, text FROM ids JOIN numbered n ON n.conv_id = ids.base WHERE place <= h
), sequences AS (
  SELECT ids.conv_id,
         coalesce(list({'role': role, 'text': text} ORDER BY place) FILTER (WHERE place IS NOT NULL), []) AS turns
  FROM ids LEFT JOIN rebuilt ON rebuilt.conv_id = ids.conv_id GROUP BY ids.conv_id
), members AS (
  SELECT conv_id, d, turns[1:d] AS prefix, len(turns) = d AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM sequences)
), nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ended
  FROM members GROUP BY prefix, d
), children AS (
  SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), single AS (
  SELECT nodes.prefix, nodes.d, children.n IS NULL AS leaf,
         CASE WHEN nodes.d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(nodes.prefix[nodes.d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes LEFT JOIN children ON children.prefix = nodes.prefix AND children.d = nodes.d
), below AS (
  SELECT prefix[1:k] AS prefix, k AS d, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved
  FROM (SELECT prefix, leaf, saved, unnest(range(0, d + 1)) AS k FROM single) GROUP BY ALL
)
SELECT nodes.conv_id, nodes.d AS depth, parent.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(children.n, 0) AS n_children, below.n_leaves, below.saved AS saved_tokens, sha256(nodes.ended) AS ends_sha256
FROM nodes
JOIN below ON below.prefix = nodes.prefix AND below.d = nodes.d
LEFT JOIN children ON children.prefix = nodes.prefix AND children.d = nodes.d
LEFT JOIN nodes parent ON parent.prefix = nodes.prefix[1:nodes.d - 1] AND parent.d = nodes.d - 1
"""

_RULE = """CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END"""
_VERDICT = "CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END"


def _lowered(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _parts(url: str) -> str:
    rest = f"substr({url}, strpos({url}, '://') + 3)"
    known = f"strpos({url}, '://') > 0"
    return (
        f"CASE WHEN {known} THEN {_lowered(f"regexp_extract({rest}, '^([^/?#]*)', 1)")} ELSE '' END AS host, "
        f"CASE WHEN {known} THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path"
    )


def _address(url: str) -> str:
    plain = f"regexp_extract(trim({url}), '^([^#]*)', 1)"
    head = f"regexp_extract({plain}, '^([^:/?#]+://[^/?#]*)', 1)"
    rest = f"substr({plain}, length({head}) + 1)"
    return f"CASE WHEN {head} != '' THEN {_lowered(head)} || CASE WHEN {rest} = '' THEN '/' ELSE {rest} END END"


URL_FILTERS = rf"""
WITH RECURSIVE marked AS (
  SELECT {_address('url')} AS a,
         regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gis') AS html
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL
), targets AS (
  SELECT a, replace(trim(regexp_extract(tag, '\shref\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'i')), '&amp;', '&') AS t
  FROM (SELECT a, unnest(regexp_extract_all(html, '<link\s[^>]*>', 0, 'i')) AS tag FROM marked)
  WHERE regexp_matches(tag, '\srel\s*=\s*["'']?\s*canonical\s*(["''\s/>])', 'i')
  UNION ALL
  SELECT a, replace(trim(regexp_extract(tag, '[;,"''\s]url\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'i')), '&amp;', '&')
  FROM (SELECT a, unnest(regexp_extract_all(html, '<meta\s[^>]*>', 0, 'i')) AS tag FROM marked)
  WHERE regexp_matches(tag, '\shttp-equiv\s*=\s*["'']?\s*refresh\s*(["''\s/>])', 'i')
), absolute AS (
  SELECT a, CASE
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(a, '^([^:]+:)', 1) || t
    WHEN starts_with(t, '/') THEN regexp_extract(a, '^([^:]+://[^/?#]*)', 1) || t
    WHEN starts_with(t, '?') THEN regexp_extract(a, '^([^?#]*)', 1) || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE regexp_extract(a, '^([^:]+://[^/?#]*[^?#]*/)', 1) || t END AS b
  FROM targets WHERE a IS NOT NULL AND t != ''
), links AS (
  SELECT a, {_address('b')} AS b FROM absolute WHERE b IS NOT NULL
), either_way AS (
  SELECT a, b FROM links WHERE a != b UNION SELECT b, a FROM links WHERE a != b
), reached(a, b) AS (
  SELECT a, a FROM either_way UNION SELECT reached.a, e.b FROM reached JOIN either_way e ON e.a = reached.b
), members AS (
  SELECT a, {_VERDICT} AS verdict
  FROM (SELECT a, {_RULE} AS rule FROM (SELECT a, {_parts('b')} FROM reached))
), blocked AS (
  SELECT a FROM members GROUP BY a HAVING count(*) FILTER (WHERE verdict = 'block') > 0 AND count(*) FILTER (WHERE verdict = 'allow') = 0
), ruled AS (
  SELECT page_id, url, host, path, {_RULE} AS rule
  FROM (SELECT page_id, url, {_parts("coalesce(url, '')")} FROM pages)
)
SELECT page_id, host, path, rule,
       coalesce({_VERDICT}, CASE WHEN {_address('url')} IN (SELECT a FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM ruled
"""

_TERMS = _lowered("text")
LEXICAL_SEARCH = rf"""
WITH terms AS (
  SELECT doc, doc_id, unnest(regexp_extract_all({_TERMS}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents WHERE text IS NOT NULL)
), sizes AS (
  SELECT doc, count(*) AS n FROM terms GROUP BY doc
), corpus AS (
  SELECT count(*)::BIGINT AS all_documents, sum(n)::BIGINT AS all_terms FROM sizes
), counts AS (
  SELECT doc, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM terms GROUP BY doc, term
), frequency AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * all_documents + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, corpus GROUP BY term, all_documents
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({_TERMS}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))
  GROUP BY item_id, term
), scores AS (
  SELECT item_id, counts.doc, any_value(doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_documents) // all_terms))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN frequency USING (term) JOIN sizes ON sizes.doc = counts.doc, corpus
  GROUP BY item_id, counts.doc
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""
