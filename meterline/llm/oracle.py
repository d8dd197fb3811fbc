"""SQL that gives the same rows as the training-data queries, where SQL can say it."""

from __future__ import annotations

from meterline.llm.mixing import SEEDS, multiplier
from meterline.llm.secrets import BASE_RULES, RULES, Rule

_SEEDS = ", ".join(f"({seed}, {multiplier(seed)})" for seed in range(SEEDS))

_MIXING = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS base
  FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), rounds AS (
  SELECT 1 AS turn, 0.0::DOUBLE AS before, (sum(source_size) / sum(weight))::DOUBLE AS level FROM ranked
  UNION ALL
  SELECT turn + 1, level,
         (SELECT (sum(source_size) - sum(CASE WHEN source_size * 3 < weight * level THEN source_size * 3 ELSE 0 END))
                 / sum(CASE WHEN source_size * 3 < weight * level THEN 0 ELSE weight END) FROM ranked)::DOUBLE
  FROM rounds WHERE level > before AND turn < 1000
), rated AS (
  SELECT source, source_size, least(source_size * 3.0, weight * top.level)::DOUBLE AS target
  FROM ranked CROSS JOIN (SELECT max(level) AS level FROM rounds) top
), rates AS (
  SELECT *, CASE WHEN source_size = 0 THEN 1.0 ELSE target / source_size END::DOUBLE AS rate FROM rated
), drawn AS (
  SELECT r.source, r.source_size, r.target, r.rate, v.seed, v.factor,
         sum(CASE WHEN d.base * v.factor % 4294967296 < (r.rate - floor(r.rate)) * 4294967296
                  THEN d.size ELSE 0 END) AS extra
  FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
  CROSS JOIN (VALUES {_SEEDS}) v(seed, factor) GROUP BY ALL
), chosen AS (
  SELECT *, row_number() OVER (
    PARTITION BY source ORDER BY abs(extra + source_size * floor(rate) - target), seed) AS nth
  FROM drawn
)
SELECT d.doc_id, d.size, c.source_size, c.target,
       (d.size * (floor(c.rate) + (d.base * c.factor % 4294967296
                                   < (c.rate - floor(c.rate)) * 4294967296)::INT))::BIGINT AS taken
FROM sized d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND c.nth = 1
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS words FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, {_WORDS} AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size,
         array_to_string(words[pos : pos + least(len(words), 10) - 1], ' ') AS phrase
  FROM items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) t(pos) WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT k, pos, s.size, array_to_string(words[pos : pos + s.size - 1], ' ') AS phrase
  FROM docs CROSS JOIN sizes s, unnest(range(1, len(words) - s.size + 2)) t(pos)
), hits AS (
  SELECT p.k, p.pos, p.size, w.item FROM places p JOIN windows w USING (size, phrase)
), hit_words AS (
  SELECT k, count(DISTINCT word) AS n FROM (SELECT k, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY k
), hit_items AS (
  SELECT k, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(w.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(w.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words w USING (k) LEFT JOIN hit_items i USING (k)
"""


def _secret_spans(rule: Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT k, '{rule.kind}' AS kind, {rank} AS rank,
         (list_sum(list_transform(gaps[1 : i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(matches[1 : i - 1], lambda x: length(x))), 0))::BIGINT AS start,
         length(matches[i]) AS size
  FROM (SELECT k, regexp_extract_all(text, '{pattern}') AS matches,
               regexp_extract_all(text, '{pattern}', {rule.group}) AS parts,
               regexp_split_to_array(text, '{pattern}') AS gaps
        FROM docs), unnest(range(1, len(matches) + 1)) t(i) WHERE length(parts[i]) >= {rule.least}"""


_NAMED = "string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, rank)"
_BASE = f"kind IN ({', '.join(repr(rule.kind) for rule in BASE_RULES)})"
_SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_secret_spans(rule, rank) for rank, rule in enumerate(RULES))}),
listed AS (
  SELECT k, {", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES)},
         {_NAMED} FILTER ({_BASE}) AS base, {_NAMED} AS spans
  FROM found GROUP BY k
)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0)::BIGINT AS n_{rule.kind}" for rule in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (k)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS grams
  FROM docs
), sized AS (SELECT doc_id, len(grams)::BIGINT AS n FROM sets
), flat AS (SELECT doc_id, unnest(grams) AS gram FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM flat x JOIN flat y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared s JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a
)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached JOIN sized USING (doc_id) GROUP BY doc_id
"""


_EMBEDDINGS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.93
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT r.vec_id, (SELECT count(*) FROM links WHERE a = r.vec_id) AS n_links, min(other) AS component_id,
       r.vec_id = min(other) AS kept
FROM reached r GROUP BY r.vec_id
"""


def _hashed(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in fields) + ")"


# crc32 over the digits: each is a byte to combine, then eight steps (-1) of one bit.
_CHECKSUM = """list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
    4294967295::BIGINT)"""


def _grown(name: str, bottom: str) -> str:
    """All levels over a bottom one, and the digests of each run of 16 joined."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, idx, digest, n FROM {bottom}
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 16, n
), {name}_runs AS (
  SELECT tree, level, idx // 16 AS run, string_agg(digest, '' ORDER BY idx) AS children
  FROM {name} WHERE n > 1 GROUP BY ALL
)"""


def _climbed(name: str, bottom: str, runs: str) -> str:
    return f"""
{name} AS (
  SELECT k, tree, 0 AS level, idx, n, folded, proof FROM {bottom}
  UNION ALL
  SELECT k, c.tree, c.level + 1, c.idx // 16, (c.n + 15) // 16,
         sha256(substr(children, 1, 64 * (c.idx % 16)) || folded || substr(children, 64 * (c.idx % 16) + 65)),
         proof || substr(children, 1, 64 * (c.idx % 16)) || substr(children, 64 * (c.idx % 16) + 65)
  FROM {name} c JOIN {runs} r ON r.tree = c.tree AND r.level = c.level AND r.run = c.idx // 16 WHERE c.n > 1
)"""


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS k, doc_id, source, {_hashed('text')} AS digest, {_hashed(_LOWERED)} AS other,
         xor({_CHECKSUM}, 4294967295) % 5 = 0 AS changed
  FROM documents
), placed AS (
  SELECT k, doc_id, digest, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n, CASE WHEN changed THEN other ELSE digest END AS folded, '' AS proof
  FROM leaves
), {_grown("grown", "placed")}, subroots AS (
  SELECT -1 AS tree, tree AS idx, digest, count(*) OVER () AS n FROM grown WHERE n = 1
), {_grown("upper", "subroots")}, {_climbed("inner_climb", "placed", "grown_runs")}, arrived AS (
  SELECT c.k, s.tree, s.idx, s.n, c.folded, c.proof, s.digest AS subroot
  FROM inner_climb c JOIN subroots s ON s.idx = c.tree WHERE c.n = 1
), {_climbed("outer_climb", "arrived", "upper_runs")}
SELECT p.doc_id, p.digest AS leaf, a.subroot, root.digest AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = root.digest AS verified
FROM placed p JOIN arrived a USING (k) JOIN outer_climb c ON c.k = p.k AND c.n = 1
JOIN upper root ON root.n = 1
"""


_PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM worded GROUP BY lang
), placed AS (
  SELECT lang, size, words[i : i + size - 1] AS words
  FROM worded, (VALUES (1), (2), (3)) s(size), unnest(range(1, len(words) - size + 2)) t(i)
), counted AS (SELECT lang, size, words, count(*) AS f FROM placed GROUP BY ALL
), frequent AS (SELECT * FROM counted WHERE size > 1 AND f >= 10
), parts AS (
  SELECT lang, f, unnest([words[1:2], words[2:3]]) AS words FROM frequent WHERE size = 3
), kept AS (
  SELECT * FROM frequent c
  WHERE NOT EXISTS (FROM parts p WHERE p.lang = c.lang AND p.words = c.words AND 100 * p.f >= 50 * c.f)
), cuts AS (
  SELECT c.lang, c.words, c.f AS a, k, l.f AS l, r.f AS r, 1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS score
  FROM kept c, (VALUES (1), (2)) t(k)
  JOIN counted l ON l.lang = c.lang AND l.words = c.words[1:k]
  JOIN counted r ON r.lang = c.lang AND r.words = c.words[k + 1 :]
  WHERE k < c.size
), lowest AS (
  SELECT *, array_to_string(words, ' ') AS phrase FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_queries() -> dict[str, str]:
    return {
        "op3_near_duplicates": _NEAR_DUPLICATES,
        "op4_mixing": _MIXING,
        "op5_embeddings": _EMBEDDINGS,
        "op6_decontamination": _DECONTAMINATION,
        "op7_secrets": _SECRETS,
        "op11_merkle": _MERKLE,
        "op13_phrases": _PHRASES,
    }
