"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

SEP = r"[\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SEP}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i + 1, i + 5) AS g
    FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 0))) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win)
    WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(5) AS r(k) GROUP BY doc_id),
f AS (SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
    FROM d LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS x FROM b
    WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT sum(x) / sum(n) AS m, sum(x * x / n) / sum(n) AS e2, sum(n) AS n FROM h),
p AS (SELECT m, CASE WHEN e2 - m * m > 1e-12
    THEN greatest(1.0, least(1e6, m * (1 - m) / (e2 - m * m) - 1)) ELSE 1e6 END AS k FROM m),
v AS (SELECT source, (x + m * k) / (n + k) <= 0.5 AS ok FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(ok, TRUE) AS kept
FROM b LEFT JOIN v USING (source)"""

OP3 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""

OP1 = r"""
WITH l AS (SELECT doc_id, source, i, ln, trim(ln, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS x
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS ln,
          generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
b AS (SELECT x, min((doc_id, i)) AS f FROM l WHERE x <> '' GROUP BY x
    HAVING count(DISTINCT source) >= 10),
j AS (SELECT l.*, b.f IS NOT NULL AND b.f <> (l.doc_id, l.i) AS gone FROM l LEFT JOIN b USING (x)),
g AS (SELECT doc_id, string_agg(ln, chr(10) ORDER BY i) FILTER (NOT gone) AS t,
    count(*) FILTER (x <> '') AS n, count(*) FILTER (gone) AS r FROM j GROUP BY doc_id)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t, '') END AS text,
    coalesce(n, 0) AS n_lines, coalesce(r, 0) AS n_removed FROM documents d LEFT JOIN g USING (doc_id)"""

OP5 = """
WITH o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
f AS (SELECT conv_id, role AS r1, text AS t1 FROM o WHERE i = 1),
s AS (SELECT conv_id, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS n
    FROM o GROUP BY conv_id),
c AS (SELECT conv_id, first_value(conv_id) OVER (PARTITION BY r1, t1 ORDER BY n DESC, conv_id) AS best
    FROM f JOIN s USING (conv_id)),
p AS (SELECT best AS c, conv_id AS r FROM c WHERE best <> conv_id),
l AS (SELECT conv_id, max(i) AS z, arg_min(struct_pack(text := text), i).text AS stale FROM o
    WHERE role = 'assistant' GROUP BY conv_id HAVING count(*) > 1),
a AS (SELECT c, r, i, role, text FROM p JOIN o ON conv_id = c UNION ALL
    SELECT conv_id, conv_id, i, role, text FROM o JOIN l USING (conv_id) WHERE i <= z),
b AS (SELECT c, r, i, role, text FROM p JOIN o ON conv_id = r UNION ALL
    SELECT conv_id, conv_id, i, role, CASE WHEN i = z THEN stale ELSE text END
    FROM o JOIN l USING (conv_id) WHERE i <= z),
d AS (SELECT a.c, a.r, min(a.i) - 1 AS n FROM a LEFT JOIN b USING (c, r, i)
    WHERE b.c IS NULL OR a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY ALL),
k AS (SELECT a.c, a.r, coalesce(any_value(d.n), max(a.i)) AS n FROM a LEFT JOIN d USING (c, r) GROUP BY ALL),
t AS (SELECT *, '<|' || coalesce(role, 'none') || '|>' || chr(10) AS h,
    coalesce(text, '') || '<|end|>' || chr(10) AS e, coalesce(role = 'assistant', FALSE) AS m
    FROM (SELECT 1 AS side, * FROM a UNION ALL SELECT 2, * FROM b)),
u AS (SELECT *, h || e AS x, '0:' || length(h) || ',' || CASE WHEN m THEN '1:' ELSE '0:' END
    || length(e) AS y FROM t),
g AS (SELECT c, r, n, string_agg(x, '' ORDER BY i) FILTER (side = 1 AND i <= n) AS p1,
    string_agg(x, '' ORDER BY i) FILTER (side = 1 AND i > n) AS x1,
    string_agg(y, ',' ORDER BY i) FILTER (side = 1 AND i > n) AS y1,
    string_agg(x, '' ORDER BY i) FILTER (side = 2 AND i > n) AS x2,
    string_agg(y, ',' ORDER BY i) FILTER (side = 2 AND i > n) AS y2
    FROM u JOIN k USING (c, r) GROUP BY c, r, n)
SELECT c AS chosen_id, r AS rejected_id, CAST(n AS BIGINT) AS n_prompt_turns,
    coalesce(p1, '') AS prompt, coalesce(x1, '') AS chosen_text, coalesce(y1, '') AS chosen_mask,
    coalesce(x2, '') AS rejected_text, coalesce(y2, '') AS rejected_mask FROM g"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(s, i, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
    greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 50
        THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS x,
    coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS y,
    coalesce(array_to_string(list_slice(u, b + 1, len(u)), ''), '') AS z FROM c)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
        WHEN 'spm' THEN '<S>' || z || '<P>' || x || '<M>' || y ELSE t END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM p"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": OP1,
    "op2_host_quality": OP2,
    "op3_exact_dedup": OP3,
    "op5_preference_format": OP5,
    "op13_fill_in_middle": OP13,
}
