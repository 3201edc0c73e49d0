"""Registered queries of the training-text operators, with SQL where SQL expresses them.

Each covers its whole table with the operator's own parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fathomgrid.llm import (
    collocations,
    licenses,
    merkle,
    mixing,
    orderminhash,
    packing,
    piecetokens,
    pseudonyms,
    quality,
    rules,
    setsketch,
    sharding,
    toxicity,
)
from fathomgrid.llm.common import id_remainder, table
from fathomgrid.session import use_utc


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(use_utc(spark), sf_dir, "documents")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path())


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 4) == 2
    return quality.quality(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), held_out)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(rules.ledger(_documents(spark, sf_dir)))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_documents(spark, sf_dir))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.fingerprints(_documents(spark, sf_dir))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_documents(spark, sf_dir)).drop("digest")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 5) == 0
    return toxicity.toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), held_out)


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.with_pseudonyms(_documents(spark, sf_dir).select("doc_id", "text"), pseudonyms.key_of(spark))
    return found.selectExpr(
        "doc_id",
        "text",
        "cast(size(pseudonym_kinds) as bigint) as n_replaced",
        "array_join(array_sort(array_distinct(pseudonym_kinds)), ',') as kinds",
    )


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_documents(spark, sf_dir))


def op13_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecetokens.round_trips(_documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_best_fit_packing,
        op3_quality_classifier,
        op4_source_mixing,
        op5_quality_rules,
        op6_sharding,
        op7_order_minhash,
        op8_near_dedup,
        op9_toxicity,
        op10_pii_pseudonyms,
        op11_phrase_mining,
        op12_merkle_manifest,
        op13_piece_tokens,
    )
}

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_WORD})), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS turn
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source),
weighed AS (SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS most FROM sources),
shared AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS budget,
    coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
    sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open_weight
  FROM weighed),
stopped AS (SELECT *, most * open_weight <= weight * (budget - capped) AS is_full FROM shared),
targets AS (
  SELECT source, source_size, rank, budget, CASE WHEN is_full THEN most::DOUBLE
    ELSE (weight * (budget - coalesce(sum(most) FILTER (is_full) OVER (), 0)::BIGINT))::DOUBLE
      / (sum(weight) FILTER (NOT is_full) OVER ())::DOUBLE END AS target
  FROM stopped),
queued AS (
  SELECT s.*, t.source_size, t.rank, t.budget, t.target,
    sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.turn, s.doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS up_to
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, unnest(range(0, greatest(1, ceil(target / nullif(source_size, 0))::BIGINT))) AS again FROM queued),
merged AS (SELECT *, (again * source_size + up_to)::DOUBLE / nullif(target, 0) AS finish FROM turns),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish NULLS LAST, rank, turn, doc_id, again ROWS UNBOUNDED PRECEDING) AS used FROM merged)
SELECT doc_id, size, source_size, target,
  (size * count(*) FILTER (used <= budget AND finish IS NOT NULL AND size > 0))::BIGINT AS taken,
  (count(*) FILTER (used <= budget AND finish IS NOT NULL AND size > 0))::BIGINT AS copies
FROM cut GROUP BY doc_id, size, source_size, target
"""

_BITS = " + ".join(f"CASE WHEN {c} THEN {rules.BITS[r]} ELSE 0 END" for r, c in rules.RULES.items())
_RULES = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_WORD})) AS lines
  FROM documents),
each AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT doc_id, i, w AS a, lead(w) OVER d AS b, lead(w, 2) OVER d AS c
  FROM each WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM windows WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
measured AS (
  SELECT s.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
book AS (SELECT *, ({_BITS})::BIGINT AS failed FROM measured)
SELECT *, failed & {rules.policy_mask(rules.BASE_POLICY)} <> 0 AS base_failed,
  failed & {rules.policy_mask(rules.CURRENT_POLICY)} = 0 AS kept
FROM book
"""

_DEDUP = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWERED}, ''), {_WORD}) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS items
  FROM split),
sizes AS (SELECT doc_id, len(items)::BIGINT AS n FROM sets),
each AS (SELECT doc_id, unnest(items) AS item FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM each x JOIN each y ON x.item = y.item AND x.doc_id < y.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * k >= 75 * (p.n + q.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT ways.b, root FROM reached JOIN ways ON reached.doc_id = ways.a)
SELECT s.doc_id, s.n AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sizes s JOIN (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id) r ON s.doc_id = r.doc_id
"""

_PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM split, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r,
    ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
absorbed AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c
  JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM candidates WHERE k = 3) t
    ON t.lang = c.lang AND t.part = c.phrase AND 100 * t.a >= 50 * c.a WHERE c.k = 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM lowest ANTI JOIN absorbed USING (lang, phrase) JOIN sizes USING (lang) QUALIFY rank <= 2000
"""

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_ROW = " || ".join(_FIELD.format(c) for c in merkle.FIELDS)
_CHANGED = " || ".join(_FIELD.format("(n_chars + 1)" if c == "n_chars" else c) for c in merkle.FIELDS)
# crc32 of the id's decimal text, bit by bit: eight steps per character.
_CRC = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::UBIGINT for k in range(8)]),
        lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END))"""
_MERKLE = rf"""
WITH RECURSIVE rows AS (
  SELECT coalesce('1' || lang, '0') AS tree, doc_id, sha256({_ROW}) AS leaf,
    CASE WHEN xor({_CRC}, 4294967295::UBIGINT) % 7 = 0 THEN sha256({_CHANGED}) END AS changed
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
    count(*) OVER (PARTITION BY tree) AS n FROM rows),
level AS (
  SELECT tree, 0 AS height, rank, leaf AS node, n FROM ranked
  UNION ALL
  SELECT tree, height + 1, rank // 2, sha256(node || coalesce(mate, '')), (n + 1) // 2
  FROM (SELECT *, lead(node) OVER (PARTITION BY tree ORDER BY rank) AS mate FROM level WHERE n > 1) WHERE rank % 2 = 0),
subroots AS (
  SELECT tree, node AS subroot, height AS below, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n
  FROM level WHERE n = 1),
upper AS (
  SELECT 0 AS height, place AS rank, subroot AS node, n FROM subroots
  UNION ALL
  SELECT height + 1, rank // 2, sha256(node || coalesce(mate, '')), (n + 1) // 2
  FROM (SELECT *, lead(node) OVER (ORDER BY rank) AS mate FROM upper WHERE n > 1) WHERE rank % 2 = 0),
top AS (SELECT node AS root FROM upper WHERE n = 1),
steps AS (
  SELECT r.tree, r.rank, l.height AS step, (r.rank >> l.height) % 2 AS side, s.node AS sibling
  FROM ranked r JOIN level l ON l.tree = r.tree AND l.rank = (r.rank >> l.height) AND l.n > 1
  LEFT JOIN level s ON s.tree = l.tree AND s.height = l.height AND s.rank = xor(l.rank, 1)
  UNION ALL
  SELECT r.tree, r.rank, b.below + u.height, (b.place >> u.height) % 2, s.node
  FROM ranked r JOIN subroots b ON b.tree = r.tree JOIN upper u ON u.rank = (b.place >> u.height) AND u.n > 1
  LEFT JOIN upper s ON s.height = u.height AND s.rank = xor(u.rank, 1)),
paths AS (
  SELECT tree, rank, string_agg(coalesce(sibling, ''), '' ORDER BY step) AS proof,
    list(coalesce(CASE WHEN side = 1 THEN '<' ELSE '>' END || sibling, '=') ORDER BY step) AS path
  FROM steps GROUP BY tree, rank)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM (
  SELECT r.*, subroot, root, proof, list_reduce(list_prepend(coalesce(changed, leaf), coalesce(path, [])),
    lambda node, step: sha256(CASE WHEN step[1] = '<' THEN step[2:] || node ELSE node || step[2:] END)) AS folded
  FROM ranked r JOIN subroots USING (tree) CROSS JOIN top LEFT JOIN paths USING (tree, rank))
"""

ORACLES = {"op11_phrase_mining": _PHRASES, "op12_merkle_manifest": _MERKLE, "op4_source_mixing": _MIXING, "op5_quality_rules": _RULES, "op8_near_dedup": _DEDUP}
