"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from freightlens.llm.licences import HARD_END, HINT, RULES, SENTENCE_END, SENTENCES, SOFT_END
from freightlens.llm.mixing import NOTHING_LEFT
from freightlens.llm.queries import TARGETS

EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       text_sha256
FROM d
WINDOW g AS (PARTITION BY text_sha256)
"""



BACKOFF = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
w AS (SELECT doc_id, unnest(words) AS b, unnest(range(len(words))) AS i FROM t),
p AS (SELECT *, lag(b) OVER d AS a, lag(b, 2) OVER d AS z FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
one AS (SELECT b AS x, count(*) AS n FROM w GROUP BY b),
one_own AS (SELECT doc_id, b AS x, count(*) AS n FROM w GROUP BY ALL),
two AS (SELECT a, b, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY ALL),
two_own AS (SELECT doc_id, a, b, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY ALL),
three AS (SELECT z, a, b, count(*) AS n FROM p WHERE z IS NOT NULL GROUP BY ALL),
three_own AS (SELECT doc_id, z, a, b, count(*) AS n FROM p WHERE z IS NOT NULL GROUP BY ALL),
c AS (
  SELECT p.doc_id, p.a, p.z, k.n - l.n AS triple, q.n - r.n AS before, g.n - h.n AS pair,
         x.n - y.n AS context, u.n - v.n AS single,
         (SELECT count(*) FROM w) - len(t.words) AS others
  FROM p JOIN t USING (doc_id)
  JOIN one u ON u.x = p.b JOIN one_own v ON v.x = p.b AND v.doc_id = p.doc_id
  LEFT JOIN two g ON g.a = p.a AND g.b = p.b
  LEFT JOIN two_own h ON h.a = p.a AND h.b = p.b AND h.doc_id = p.doc_id
  LEFT JOIN one x ON x.x = p.a LEFT JOIN one_own y ON y.x = p.a AND y.doc_id = p.doc_id
  LEFT JOIN three k ON k.z = p.z AND k.a = p.a AND k.b = p.b
  LEFT JOIN three_own l ON l.z = p.z AND l.a = p.a AND l.b = p.b AND l.doc_id = p.doc_id
  LEFT JOIN two q ON q.a = p.z AND q.b = p.a
  LEFT JOIN two_own r ON r.a = p.z AND r.b = p.a AND r.doc_id = p.doc_id),
s AS (
  SELECT doc_id,
         CASE WHEN z IS NOT NULL AND triple > 0 THEN 0
              ELSE (z IS NOT NULL)::BIGINT + (a IS NOT NULL AND pair = 0)::BIGINT END AS back,
         CASE WHEN z IS NOT NULL AND triple > 0 THEN ln(triple) - ln(before)
              WHEN a IS NOT NULL AND pair > 0 THEN ln(pair) - ln(context)
              ELSE ln(greatest(single, 0.5::DOUBLE)) - ln(greatest(others, 1)) END AS score
  FROM c),
d AS (SELECT doc_id, sum(back)::BIGINT AS n_backoffs, sum(score + back * ln(0.4::DOUBLE)) AS score FROM s GROUP BY doc_id)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(n_backoffs, 0)::BIGINT AS n_backoffs,
       round(coalesce(score, 0), 4) AS log_score, round(score / nullif(len(t.words), 0), 4) AS mean_log_score
FROM t LEFT JOIN d USING (doc_id)
"""


HARD_NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS whole
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.whole, b.whole)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_SIZED = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_SIZED.format(f) for f in ("doc_id", "source", "lang", "{0}", "text")) + ")"
#: CRC-32 of the decimal doc_id, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i::INTEGER, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, zero: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""

MERKLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, {_LEAF.format("n_chars")} AS leaf,
         {_LEAF.format(f"(n_chars + CASE WHEN {_CRC32} % 7 = 0 THEN 1 ELSE 0 END)")} AS shown
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         row_number() OVER () AS rn
  FROM leaves),
tree(g, level, pos, h) AS (
  SELECT g, 0, pos, leaf FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS nodes FROM tree) WHERE nodes > 1
  GROUP BY g, level, pos // 2),
subroots AS MATERIALIZED (
  SELECT g, max(level) AS height, arg_max(h, level) AS subroot FROM tree GROUP BY g),
top(level, pos, h) AS (
  SELECT 0, g, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS nodes FROM top) WHERE nodes > 1
  GROUP BY level, pos // 2),
root AS (SELECT max(level) AS height, arg_max(h, level) AS root FROM top),
steps AS MATERIALIZED (
  SELECT p.rn, t.level, t.pos < (p.pos >> t.level) AS is_left, t.h
  FROM placed p JOIN subroots s USING (g) JOIN tree t
    ON t.g = p.g AND t.level < s.height AND t.pos = xor(p.pos >> t.level, 1)
  UNION ALL
  SELECT p.rn, s.height + t.level, t.pos < (p.g >> t.level), t.h
  FROM placed p JOIN subroots s USING (g) CROSS JOIN root r JOIN top t
    ON t.level < r.height AND t.pos = xor(p.g >> t.level, 1)),
folded(rn, level, last, h) AS (
  SELECT p.rn, 0, s.height + r.height, p.shown FROM placed p JOIN subroots s USING (g) CROSS JOIN root r
  UNION ALL
  SELECT f.rn, f.level + 1, f.last, sha256(CASE WHEN x.h IS NULL THEN f.h WHEN x.is_left THEN x.h || f.h ELSE f.h || x.h END)
  FROM folded f LEFT JOIN steps x ON x.rn = f.rn AND x.level = f.level WHERE f.level < f.last),
proofs AS (SELECT rn, sha256(string_agg(h, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY rn)
SELECT p.doc_id, p.leaf, s.subroot, r.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
       f.h AS folded_root, f.h = r.root AS verified
FROM placed p JOIN subroots s USING (g) CROSS JOIN root r
JOIN folded f ON f.rn = p.rn AND f.level = f.last LEFT JOIN proofs q ON q.rn = p.rn
"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _raking(rounds: int = 12) -> str:
    """Every round of the raking as common table expressions."""
    steps = []
    for m, targets in TARGETS.items():
        target = " ".join(f"WHEN {_quoted(k)} THEN {v}::DOUBLE" for k, v in targets.items())
        # Where the targets leave nothing over, unnamed values keep the share they have.
        rest = 1.0 - sum(targets.values())
        rest = f"{rest!r}::DOUBLE" if rest > NOTHING_LEFT else """coalesce(
      sum(target) OVER () * sum(have) FILTER (target IS NULL) OVER ()
        / nullif(sum(have) FILTER (target IS NOT NULL) OVER (), 0), 1)"""
        steps.append(f"""have_{m} AS MATERIALIZED (
  SELECT {m}, sum(tokens)::DOUBLE AS have, CASE {m} {target} END AS target
  FROM cells GROUP BY {m} HAVING sum(tokens) > 0),
part_{m} AS MATERIALIZED (
  SELECT {m}, coalesce(target, {rest} * have / sum(have) FILTER (target IS NULL) OVER ()) AS w
  FROM have_{m}),
want_{m} AS MATERIALIZED (SELECT {m}, w / sum(w) OVER () AS want FROM part_{m})""")
    last = "start"
    for i in range(rounds):
        for m in TARGETS:
            steps.append(f"""r{i}_{m} AS MATERIALIZED (
  SELECT c.* REPLACE (c.weight * w.want / sum(c.weight) OVER (PARTITION BY c.{m}) AS weight)
  FROM {last} c JOIN want_{m} w ON w.{m} = c.{m})""")
            last = f"r{i}_{m}"
    steps.append(f"raked AS MATERIALIZED (SELECT *, weight / tokens AS ratio FROM {last})")
    return ",\n".join(steps)


MIXING = rf"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
         CASE WHEN contains(t, 'icense') THEN 'licence'
              WHEN contains(t, ' | ') THEN 'table'
              WHEN contains(t, '@') THEN 'contact'
              WHEN contains(t, '!! ') OR contains(t, '*** ') THEN 'noise'
              ELSE 'prose' END AS topic,
         len(regexp_extract_all(t, '[^ \t\r\n]+'))::BIGINT AS tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
start AS (SELECT *, tokens::DOUBLE AS weight FROM cells WHERE tokens > 0),
{_raking()},
found AS (
  SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens,
         d.tokens * coalesce(r.ratio, 0) AS weight,
         coalesce(r.ratio * (SELECT sum(tokens) FROM cells), 0) AS probability,
         ('0x' || substr(md5('0:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM docs d LEFT JOIN raked r USING (source, lang, topic)
)
SELECT doc_id, source, lang, topic, tokens, round(weight, 8) AS weight,
       round(probability, 6) AS probability,
       (floor(probability) + (u < probability - floor(probability))::INTEGER)::INTEGER AS copies
FROM found
"""


def _licences() -> str:
    """The rules one after the other as common table expressions."""
    keys = ", ".join(map(_quoted, SENTENCES))
    ids = ", ".join(map(_quoted, SENTENCES.values()))
    # Borders of sentences are doubled, so that two neighbours each have their own.
    any_of = "|".join(
        x.replace(" ", "(?: |~~)") for x in sorted(SENTENCES, key=lambda x: (-len(x), x))
    )
    plain = "translate(lower(coalesce(text, '')), '~', ' ')"
    for sought, put in ((HARD_END, "~~"), (SOFT_END, "~"), ("[^a-z0-9~]+", " "), (" ?~ ?", "~")):
        plain = f"regexp_replace({plain}, {_quoted(sought)}, '{put}', 'g')"
    steps = [f"""cut AS (
  SELECT doc_id, len(list_filter(string_split_regex(coalesce(text, ''), {_quoted(SENTENCE_END)}),
           lambda x: regexp_replace(x, '[ \\t\\r\\n]+', '', 'g') <> ''))::INTEGER AS n_sentences,
         CASE WHEN regexp_matches(coalesce(text, ''), {_quoted(HINT)})
              THEN replace('~' || trim({plain}) || '~', '~', '~~') ELSE '' END AS said
  FROM documents),
known AS (
  SELECT doc_id, n_sentences, list_transform(regexp_extract_all(said, {_quoted(f"~({any_of})~")}, 1),
    lambda x: [{ids}][list_position([{keys}], replace(x, '~~', ' '))]) AS ids
  FROM cut),
rule0 AS (
  SELECT *, coalesce(array_to_string(list_transform(ids, lambda x: '<' || x || '>'), ''), '') AS rest,
         []::VARCHAR[] AS names FROM known)"""]
    for i, (name, sequence) in enumerate(RULES):
        sought = _quoted("".join(f"<{x}>" for x in sequence))
        steps.append(f"""rule{i + 1} AS (
  SELECT doc_id, n_sentences, ids, replace(rest, {sought}, '|') AS rest,
         CASE WHEN contains(rest, {sought}) THEN list_append(names, {_quoted(name)}) ELSE names END AS names
  FROM rule{i})""")
    return f"""WITH {", ".join(steps)}
SELECT doc_id, n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(list_sort(list_distinct(names)), ','), '') AS licences,
       (length(rest) - length(replace(rest, '<', '')))::INTEGER AS n_unmatched
FROM rule{len(RULES)}"""


ORACLES = {
    "op1_source_mixing": MIXING,
    "op5_licence_scan": _licences(),
    "op9_backoff_lm": BACKOFF,
    "op10_exact_dedup": EXACT_DEDUP,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_merkle_manifest": MERKLE,
}
