"""DuckDB SQL for the queries that SQL can express. Constants are written out, not imported."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, unnest(range(1, len(ls) + 1)) AS i, ls FROM d),
k AS (SELECT r, i, ls[i] AS line,
             {_LOWER.format(r"regexp_replace(regexp_replace(ls[i], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')")} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
s AS (SELECT r, count(*) AS n_lines, count(f.key) AS n_dropped,
             string_agg(CASE WHEN f.key IS NULL THEN line END, chr(10) ORDER BY i) AS kept
      FROM k LEFT JOIN f ON k.key = f.key GROUP BY r)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d JOIN s USING (r)
"""

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, w FROM d),
words AS (SELECT r, i, w[i] AS a FROM p),
top AS (SELECT r, max(c) AS c FROM (SELECT r, a, count(*) AS c FROM words GROUP BY r, a) GROUP BY r),
tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM p WHERE i + 2 <= len(w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r),
chars AS (SELECT r, sum(length(a)) AS n FROM words GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(DISTINCT x) AS u FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
          WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
b AS (SELECT doc_id, t, len(w)::BIGINT AS n_words, coalesce(chars.n, 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(lines.n - lines.u, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             coalesce(lines.n, 0) AS n_lines, coalesce(top.c, 0) AS top
      FROM d LEFT JOIN chars USING (r) LEFT JOIN lines USING (r) LEFT JOIN rep USING (r) LEFT JOIN top USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars > 15 * n_words
         OR 10 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * word_chars
         OR 10 * (length(t) - length(replace(t, '!', ''))) > 3 * n_words
         OR 10 * top > 3 * n_words
         OR 2 * length(regexp_replace(t, '[^0-9]', '', 'g')) > word_chars) AS kept
FROM f
"""

_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_TERMS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN sizes ON len(w) >= n)),
m AS (SELECT r, i, n, item FROM dw JOIN bw USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS c FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
it AS (SELECT r, count(*) AS c, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.c, 0)::BIGINT AS n_hit, coalesce(it.c, 0)::BIGINT AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256, coalesce(hit.c, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""

_CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE:", "[/ROLE]", "<|image:", "<|audio:", "<|document:")


def _escaped(c: str) -> str:
    """Length of an escaped text: a character more for each backslash and each control string."""
    extra = [f"length({c}) - length(replace({c}, chr(92), ''))"]
    extra += [f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in _CONTROLS]
    return f"(length({c}) + " + " + ".join(extra) + ")"


OP6 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, {_escaped("text")} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 17
             ELSE 16 + {_escaped("role")} + length(role) - length(replace(role, ']', '')) END AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

_HEX = " + ".join(f"(strpos('0123456789abcdef', substr(h, {i}, 1)) - 1) * {16 ** (4 - i)}" for i in range(1, 5))

OP10 = f"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, [5.0, 2.0, 1.0][((rank - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM r),
q AS (SELECT *, cap / weight AS ratio FROM w),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM q),
t AS (SELECT source, source_size, coalesce(least(cap, (max(CASE WHEN level < ratio THEN level END) OVER ()) * weight), cap) AS target,
             md5('0:' || coalesce('s' || source, '')) AS h FROM v),
o AS (SELECT source, source_size, target, coalesce(target / nullif(source_size, 0), 0) AS rate, ({_HEX}) / 65536.0::DOUBLE AS u FROM t),
p AS (SELECT *, CASE WHEN substr(h, 3, 1) < '8' THEN size ELSE 1099511627776 - size END AS place FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY place, substr(h, 1, 2), h) AS k FROM p)
SELECT doc_id, size, source_size, target,
       ((floor(rate * k + u) - floor(rate * (k - 1) + u))::BIGINT * size)::BIGINT AS taken
FROM n JOIN o ON n.source IS NOT DISTINCT FROM o.source
"""

OP11 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k >= 2),
s AS (SELECT c.lang, c.k, c.phrase, c.a, x.f AS l, y.f AS r, t.n, cut, ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
      FROM c JOIN t USING (lang)
      JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
      JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
d AS (SELECT a.lang, a.phrase FROM m a JOIN m b
      ON a.lang = b.lang AND b.k > a.k AND 100 * b.a >= 100 * a.a AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' ')),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
      FROM m ANTI JOIN d USING (lang, phrase))
SELECT * FROM o WHERE rank <= 2000
"""

_SEARCH_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SEARCH_TERMS} AS w FROM documents),
t AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, {_SEARCH_TERMS} AS w FROM benchmark),
it AS (SELECT q, term, count(*)::BIGINT AS asked FROM (SELECT q, unnest(w) AS term FROM i) GROUP BY q, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term),
wt AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, c),
m AS (SELECT r, doc_id, 25 + (75 * len(w)::BIGINT * n_docs) // n_terms AS m FROM d, c WHERE len(w) > 0),
s AS (SELECT q, r, sum(asked * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM it JOIN wt USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY q, r),
o AS (SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank, doc_id, score
      FROM s JOIN m USING (r) JOIN i USING (q) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10
"""

ORACLE = {
    "op1_line_dedup": OP1,
    "op2_quality_rules": OP2,
    "op4_benchmark_decontamination": OP4,
    "op6_chat_formatting": OP6,
    "op10_mixing": OP10,
    "op11_collocations": OP11,
    "op13_ranked_search": OP13,
}
