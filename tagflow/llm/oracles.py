"""DuckDB SQL with the rows of the operators that SQL expresses."""

from __future__ import annotations

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_GRAM = "array_to_string(list_slice(w, i, i + {n} - 1), ' ')"
PHRASES = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWERED.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS ({" UNION ALL ".join(f"SELECT lang, {n} AS words, {_GRAM.format(n=n)} AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM words WHERE len(w) >= {n})" for n in range(1, 5))}),
f AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30),
cuts AS (SELECT lang, words, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:words], ' ') AS tail FROM (SELECT *, unnest(range(1, words)) AS k FROM c)),
scores AS (SELECT cuts.*, x.f AS l, y.f AS r, ((2000000 * a::HUGEINT) // (x.f::HUGEINT + y.f))::BIGINT AS score FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS p FROM scores) WHERE p = 1),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS inner_phrase, a FROM (SELECT *, unnest(range(1, words - m + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS m FROM c WHERE words > 2))),
most AS (SELECT lang, inner_phrase, max(a) AS most FROM inside GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN most ON most.lang = lowest.lang AND inner_phrase = phrase WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT)
SELECT * FROM (SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN totals ON totals.lang = kept.lang) WHERE rank <= 2000"""

# The CRC-32 of the digits of conv_id: one step for each character, eight shifts each.
_CRC = "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)), lambda crc, b: list_reduce([xor(crc, b), 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT], lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::UBIGINT) ELSE y // 2 END)), 4294967295::UBIGINT)"
TRIE = f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id AS c, 0 AS own, pos, role, text FROM c JOIN t ON t.conv_id = base AND pos <= h UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
r AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, role, text FROM b),
p AS (SELECT c, d, text, list(role || chr(0) || text || chr(1)) OVER (PARTITION BY c ORDER BY d) AS path FROM r),
path AS (SELECT c, d, text, sha256(array_to_string(path, chr(2))) AS node FROM p UNION ALL SELECT conv_id, 0, '', 'root' FROM c),
size AS (SELECT c, max(d) AS size FROM path GROUP BY c),
n AS (SELECT node, d, min(path.c) AS conv_id, count(*) AS n_convs, any_value(length(text)) AS chars, string_agg(CASE WHEN size = d THEN CAST(path.c AS VARCHAR) END, ',' ORDER BY path.c) AS ended FROM path JOIN size ON size.c = path.c GROUP BY node, d),
up AS (SELECT n.*, q.node AS above FROM n LEFT JOIN path q ON q.c = n.conv_id AND q.d = n.d - 1),
kids AS (SELECT above AS node, count(*) AS n_children FROM up WHERE above IS NOT NULL GROUP BY above),
sums AS (SELECT q.node, count(CASE WHEN k.n_children IS NULL THEN 1 END) AS n_leaves, sum((up.n_convs - 1) * up.chars)::BIGINT AS saved_tokens FROM up JOIN path q ON q.c = up.conv_id AND q.d <= up.d LEFT JOIN kids k ON k.node = up.node GROUP BY q.node)
SELECT up.conv_id, up.d::BIGINT AS depth, a.conv_id AS parent_conv_id, up.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(up.ended, '')) AS ends_sha256
FROM up JOIN sums ON sums.node = up.node LEFT JOIN kids ON kids.node = up.node LEFT JOIN n a ON a.node = up.above"""

SUBTREES = """WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS seq FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
m AS (SELECT seq, min(doc_id) AS low FROM s GROUP BY seq),
hit AS (SELECT doc_id, list(i) AS places FROM s JOIN m ON m.seq = s.seq WHERE low < doc_id GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM (SELECT doc_id, unnest(places) AS i FROM hit)),
kept AS (SELECT x.doc_id, count(gone.k) AS n_removed, string_agg(CASE WHEN gone.k IS NULL THEN word END, ' ' ORDER BY x.k) AS rest FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM w) x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.k = x.k GROUP BY x.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""

TOP_SCORES = """WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
 SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0)) WHERE rank <= 20"""
