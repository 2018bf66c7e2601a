"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

ORACLE = {
    "op4_benchmark_decontamination": r"""
WITH norm AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bench AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM bench WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
found AS (
  SELECT d.doc_id, d.i, d.n, w.item
  FROM (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM norm, sizes WHERE len(ws) >= n)) d
  JOIN wins w ON w.n = d.n AND w.win = d.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
        FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_source_divergence_audit": r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tok AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM tok GROUP BY ALL HAVING count(DISTINCT d) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
cnt AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cnt GROUP BY ALL) USING (lang, source)),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT)) // CAST(g.n + g.v AS HUGEINT) AS HUGEINT) AS p
  FROM grp g JOIN kept k USING (lang) LEFT JOIN cnt c USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
whole AS (
  SELECT c.lang, c.term, CAST(1 + (1000000000 * CAST(sum(c.n) + 1 AS HUGEINT)) // CAST(any_value(t.n) AS HUGEINT) AS HUGEINT) AS q
  FROM cnt c JOIN (SELECT lang, sum(n) + max(v) AS n FROM grp GROUP BY ALL) t USING (lang) GROUP BY c.lang, c.term),
terms AS (
  SELECT d.lang, d.source, 'term' AS part, d.term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM dense d JOIN whole USING (lang, term) WHERE d.n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 200""",
    "op12_fill_in_middle": r"""
WITH cut AS (
  SELECT doc_id, text, ls, len(ls) AS n, least(a % (len(ls) + 1), b % (len(ls) + 1)) AS x, greatest(a % (len(ls) + 1), b % (len(ls) + 1)) AS y, c, d
  FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls,
               CAST('0x' || h[1:8] AS BIGINT) AS a, CAST('0x' || h[9:16] AS BIGINT) AS b,
               CAST('0x' || h[17:24] AS BIGINT) AS c, CAST('0x' || h[25:32] AS BIGINT) AS d
        FROM (SELECT *, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents))),
parts AS (
  SELECT doc_id, text, n, array_to_string(ls[1:x], '') AS p, array_to_string(ls[x + 1:y], '') AS m, array_to_string(ls[y + 1:], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c % 100 >= 100 THEN 'plain'
              WHEN d % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts""",
    "op13_line_dedup": r"""
WITH ls AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
rows AS (
  SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos,
         translate(trim(unnest(l), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM ls),
rep AS (SELECT k, min(doc_id) AS first FROM rows WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT r, rows.doc_id, line, pos, first IS NOT NULL AND first <> rows.doc_id AS gone FROM rows LEFT JOIN rep ON rep.k = rows.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id""",
}
