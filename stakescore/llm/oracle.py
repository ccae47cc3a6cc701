"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

from stakescore.llm import license_scan, line_dedup, vector_codes, warc

OP8 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP7 = f"""
WITH split AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
counted AS (
  SELECT source, line, count(*) AS pages FROM (
    SELECT source, unnest(list_distinct(list_transform(lines, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line FROM split
  ) WHERE line <> '' GROUP BY source, line
),
bad AS (
  SELECT source, list(line) AS bad FROM counted JOIN (SELECT source, count(*) AS n FROM split GROUP BY source) USING (source)
  WHERE pages >= {line_dedup.MIN_PAGES} AND pages > {line_dedup.RATIO} * n GROUP BY source
),
cut AS (
  SELECT *, CASE WHEN bad IS NULL THEN lines
    ELSE list_filter(lines, lambda x: NOT list_contains(bad, trim(x, ' ' || chr(9) || chr(13)))) END AS kept
  FROM split LEFT JOIN bad USING (source)
)
SELECT doc_id, source, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped,
       CASE WHEN lines IS NOT NULL THEN sha256(array_to_string(kept, chr(10))) END AS text_sha256 FROM cut
"""

#: The path that op6 gives a document: one to three folders, and every tenth name is a licence file's.
DOCUMENT_PATH = """concat_ws('/', source, CASE WHEN doc_id % 3 >= 1 THEN lang END,
  CASE WHEN doc_id % 3 = 2 THEN CAST(CAST(floor(doc_id / 100) AS BIGINT) AS STRING) END,
  concat(CASE WHEN doc_id % 10 = 0 THEN 'LICENSE' ELSE 'file' END, '.', CAST(doc_id AS STRING)))"""


def op6() -> str:
    rows = ", ".join(
        f"({i}, '{name}', '{word}', {words.count(word)})"
        for i, (name, text) in enumerate(license_scan.TEMPLATES)
        for words in [license_scan.words(text)]
        for word in sorted(set(words))
    )
    split = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')".format
    return f"""
WITH templates(template, licence, word, n) AS (VALUES {rows}),
files AS (SELECT doc_id, {DOCUMENT_PATH} AS path, text FROM documents),
total AS (SELECT count(*) AS files FROM files),
contained AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct({split('text')})) AS word FROM files)
  WHERE word IN (SELECT word FROM templates) GROUP BY word
),
idf AS (
  SELECT DISTINCT t.word, ln((1 + files) / (1 + coalesce(c.n, 0))) + 1 AS idf
  FROM templates t LEFT JOIN contained c ON t.word = c.word, total
),
weights AS (SELECT template, licence, word, n * idf AS w FROM templates JOIN idf USING (word)),
norms AS (SELECT template, sqrt(sum(w * w)) AS norm FROM weights GROUP BY template),
units AS (
  SELECT DISTINCT path, unnest(CASE WHEN doc_id % 10 = 0 THEN list_append(string_split(text, chr(10)), text)
                               ELSE string_split(text, chr(10)) END) AS line FROM files
),
counts AS (
  SELECT path, line, word, count(*) AS n FROM (
    SELECT path, line, unnest(words) AS word FROM (SELECT path, line, {split('line')} AS words FROM units)
    WHERE list_has_any(words, (SELECT list(word) FROM idf))
  ) GROUP BY path, line, word
),
weighed AS (
  SELECT path, line, c.word, n * coalesce(idf, ln((1 + files) / 2) + 1) AS w FROM counts c LEFT JOIN idf ON c.word = idf.word, total
),
unit_norms AS (SELECT path, line, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY path, line),
scores AS (
  SELECT d.path, licence, round(d.dot / (u.norm * n.norm), 6) AS score FROM (
    SELECT path, line, template, licence, sum(a.w * b.w) AS dot FROM weighed a JOIN weights b USING (word)
    GROUP BY path, line, template, licence
  ) d JOIN unit_norms u USING (path, line) JOIN norms n USING (template)
),
own AS (
  SELECT path, licence, score FROM scores WHERE score >= {license_scan.THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, licence) = 1
),
folders AS (SELECT doc_id, path, string_split(path, '/')[:-2] AS folder FROM files),
licensed AS (
  SELECT folder, licence, path AS source FROM own JOIN folders USING (path) WHERE doc_id % 10 = 0
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, path) = 1
),
nearest AS (
  SELECT f.folder, l.licence, l.source FROM (SELECT DISTINCT folder FROM folders) f
  JOIN licensed l ON f.folder[:len(l.folder)] = l.folder
  QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY len(l.folder) DESC) = 1
)
SELECT doc_id, f.path, coalesce(o.licence, n.licence) AS licence, o.score,
       CASE WHEN o.licence IS NOT NULL THEN 'notice' WHEN n.licence IS NOT NULL THEN 'inherited' END AS how,
       CASE WHEN o.licence IS NOT NULL THEN f.path ELSE n.source END AS source
FROM folders f LEFT JOIN own o USING (path) LEFT JOIN nearest n USING (folder)
"""


OP13 = f"""
WITH sized AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
placed AS (
  SELECT *, payload_bytes >= {warc.SMALLEST} AND row_number() OVER same > 1 AS again, first_value(page_id) OVER same AS first_id
  FROM sized WINDOW same AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to FROM placed
"""


def op11() -> str:
    """Plain k-means in whole numbers, each round's assignments from all distances."""
    steps = []
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(f"""assigned{k} AS MATERIALIZED (
  SELECT r, p, min(s * {vector_codes.ENTRIES} + e) % {vector_codes.ENTRIES} AS e, min(s) AS s FROM (
    SELECT r, p, e, sum((v - c) * (v - c)) AS s FROM places JOIN book{k} USING (p, i) GROUP BY r, p, e
  ) GROUP BY r, p)""")
        if k < vector_codes.ROUNDS:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, i, coalesce(m, c) AS c FROM book{k} LEFT JOIN (
    SELECT p, e, i, (sum(v) - (sum(v) % count(*) + count(*)) % count(*)) // count(*) AS m
    FROM places JOIN assigned{k} USING (r, p) GROUP BY p, e, i
  ) USING (p, e, i))""")
    last = vector_codes.ROUNDS
    return f"""
WITH usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS r, * FROM usable
  WHERE len(x) = (SELECT len(x) FROM usable GROUP BY len(x) ORDER BY count(*) DESC, len(x) LIMIT 1)
),
places AS MATERIALIZED (
  SELECT r, i // (n // {vector_codes.PARTS}) AS p, i % (n // {vector_codes.PARTS}) AS i, CAST(v AS BIGINT) AS v
  FROM (SELECT r, len(x) AS n, unnest(x) AS v, unnest(range(len(x))) AS i FROM vectors)
),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, v AS c FROM places WHERE r <= {vector_codes.ENTRIES}),
{", ".join(steps)},
errors AS (
  SELECT r, string_agg(lpad(to_hex(e), 2, '0'), '' ORDER BY p) AS code, CAST(sum(s) AS BIGINT) AS error FROM assigned{last} GROUP BY r
),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM vectors JOIN errors USING (r), digest
"""


def statements() -> dict[str, str]:
    return {"op6_license_scan": op6(), "op7_line_dedup": OP7, "op8_exact_dedup": OP8, "op11_vector_codes": op11(), "op13_warc": OP13}
