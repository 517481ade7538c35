"""Registered queries of the operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import anchors, annpartition, chains, dartminhash, dualtree, langid, packing, pareto, pieces, quotes, rules, sitequality, suffix
from tallyframe.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM m WHERE len(w) > 2)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
b AS (SELECT m.doc_id, len(w)::BIGINT AS n_words,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  length(regexp_replace(t, '[^\p{Lu}]+', '', 'g'))::BIGINT AS n_upper,
  len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(n, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN cover ON m.doc_id = cover.doc_id),
f AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
  + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
  + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT
  + 32 * (2 * n_upper > word_chars)::BIGINT AS fail_bits FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  fail_bits = 0 AS kept, n_lines, n_upper, fail_bits FROM f""")
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    book = rules.ledger(table(spark, folder, "documents").select("doc_id", "text"))
    book = rules.apply_policy(rules.apply_policy(book, rules.BASE, name="base_kept"), rules.V1)
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~F.col("base_kept")).alias("base_failed"), "kept", "n_lines", "n_upper", "fail_bits")


@query("op10_site_quality")
def op10_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    feats = materialize(sitequality.features(docs))
    model = sitequality.fit(feats, table(spark, folder, "labels"))
    return sitequality.classify(docs, model, ["source", "lang"], feats=feats)


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = suffix.remove(docs, 400, keep="none", whole_chars=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


@query("op5_near_duplicates", r"""
WITH RECURSIVE t AS (SELECT text, min(doc_id) AS node FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT node, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM t),
i AS (SELECT node, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
c AS (SELECT node, array_to_string(w[i:i + 4], ' ') AS s, count(*) AS k FROM i GROUP BY ALL),
n AS (SELECT node, sum(k) AS n FROM c GROUP BY node),
p AS (SELECT a.node AS x, b.node AS y, sum(least(a.k, b.k)) AS m FROM c a JOIN c b ON a.s = b.s AND a.node < b.node
  GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.node = x JOIN n ny ON ny.node = y WHERE 10 * m >= 8 * (nx.n + ny.n - m)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(node, label) AS (SELECT node, node FROM t UNION SELECT b.y, r.label FROM r JOIN b ON b.x = r.node),
l AS (SELECT node, min(label) AS label FROM r GROUP BY node),
d AS (SELECT doc_id, coalesce(label, doc_id) AS class_id, label IS NULL AS alone FROM documents
  LEFT JOIN t USING (text) LEFT JOIN l USING (node))
SELECT doc_id, class_id, CASE WHEN alone THEN 1 ELSE count(*) OVER (PARTITION BY class_id, alone) END::BIGINT AS class_size
FROM d""")
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, folder, "documents"))


@query("op9_learned_partitions")
def op9_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return annpartition.nearest(rows, rows.where("vec_id % 20 = 0"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.predict(docs, langid.fit(docs))


@query("op4_pieces")
def op4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.summary(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


@query("op2_quotation_links", r"""
WITH RECURSIVE l0 AS (SELECT conv_id, turn, role, text, string_split(text, chr(10)) AS l FROM conversations),
m AS (SELECT *, list_filter(l, lambda x: regexp_matches(x, '^(?:[ \t]*>)+')) AS q FROM l0),
line0 AS (SELECT conv_id, turn, md5(text) AS k, i, l[i] AS line FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM m)),
line AS (SELECT conv_id, turn, k, i, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS level,
  trim(lower(regexp_replace(regexp_replace(line, '^(?:[ \t]*>)+', ''), '\s+', ' ', 'g'))) AS body FROM line0),
runs AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, k ORDER BY i)
  - row_number() OVER (PARTITION BY conv_id, turn, k, CASE WHEN body = '' THEN -1 ELSE level END ORDER BY i) AS run FROM line),
unit AS (SELECT conv_id, turn, level, md5(body) AS h, 1 AS weight FROM runs WHERE body <> '' UNION ALL
  SELECT conv_id, turn, level, md5(string_agg(body, ' ' ORDER BY i)), count(*) FROM runs WHERE body <> ''
  GROUP BY conv_id, turn, k, level, run HAVING count(*) > 1),
source AS (SELECT conv_id, h, min(turn) AS source FROM unit WHERE level = 0 GROUP BY conv_id, h),
vote AS (SELECT u.conv_id, u.turn, level, source, sum(weight) AS votes FROM unit u JOIN source s
  ON u.conv_id = s.conv_id AND u.h = s.h AND source < u.turn WHERE level > 0 GROUP BY ALL),
parent AS (SELECT conv_id, turn, source AS parent FROM vote
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, votes DESC, source) = 1),
walk AS (SELECT conv_id, turn, parent AS root, 1 AS depth FROM parent UNION ALL
  SELECT w.conv_id, w.turn, p.parent, depth + 1 FROM walk w JOIN parent p ON w.conv_id = p.conv_id AND w.root = p.turn),
top AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM walk GROUP BY conv_id, turn)
SELECT m.conv_id, m.turn, m.role, coalesce(list_max(list_transform(q, lambda x:
  length(regexp_replace(regexp_extract(x, '^(?:[ \t]*>)+'), '[^>]', '', 'g')))), 0)::INTEGER AS quote_levels, len(q)::INTEGER AS quoted_lines,
  CASE WHEN len(q) > 0 THEN trim(array_to_string(list_filter(l, lambda x: NOT regexp_matches(x, '^(?:[ \t]*>)+')
  AND NOT regexp_matches(x, '^On .{1,200} wrote:[ \t\r]*$')), chr(10)), ' ') ELSE text END AS own_text, p.parent AS parent_turn,
  coalesce(t.root, m.turn) AS root_turn, coalesce(t.depth, 0)::BIGINT AS depth,
  row_number() OVER (PARTITION BY m.conv_id ORDER BY coalesce(t.root, m.turn), m.turn)::BIGINT AS position
FROM m LEFT JOIN parent p ON m.conv_id = p.conv_id AND m.turn = p.turn LEFT JOIN top t ON m.conv_id = t.conv_id AND m.turn = t.turn""")
def op2_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    out = quotes.link(table(spark, folder, "conversations"))
    return out.select("conv_id", "turn", "role", "quote_levels", "quoted_lines", "own_text", "parent_turn", "root_turn", "depth", "position")


@query("op7_fuzzy_passages")
def op7_fuzzy_passages(spark: SparkSession, folder: str) -> DataFrame:
    return chains.mark(table(spark, folder, "documents"))


@query("op11_ranked_search", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
a AS (SELECT item_id, t, count(*) AS c FROM q GROUP BY ALL),
l AS (SELECT doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
g AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nl FROM l),
p AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g WHERE t IN (SELECT t FROM a) GROUP BY t, nd),
x AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * nd) // nl)))) AS v
  FROM p JOIN f USING (t) JOIN l USING (doc_id), g),
s AS (SELECT item_id, doc_id, sum(c * v)::BIGINT AS score FROM a JOIN x USING (t) GROUP BY ALL HAVING sum(c * v) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s
QUALIFY rank <= 10""")
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return dualtree.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_token_links")
def op13_token_links(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return anchors.link(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def _pareto_sql(rounds: int = pareto.ROUNDS) -> str:
    """The sample as SQL: the water level by a running sum, each round by another."""
    sql = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER q AS n, sum(3 * words) OVER q - 3 * words AS below,
  sum(w) OVER (ORDER BY 3.0::DOUBLE * words / w DESC, source NULLS LAST) AS rest, sum(words) OVER () AS total
  FROM s WINDOW q AS (ORDER BY 3.0::DOUBLE * words / w, source NULLS FIRST)),
v AS (SELECT arg_min((total - below)::DOUBLE / rest, n) AS level FROM o WHERE w * ((total - below)::DOUBLE / rest) <= 3 * words),
t AS (SELECT source, words, CASE WHEN w * level > 3 * words THEN (3 * words)::DOUBLE ELSE w * level END AS target FROM s, v),
f AS (SELECT source, words, target, coalesce(CASE WHEN words > 0 THEN target / words END, 0) AS copies FROM t),
r AS (SELECT d.*, words, target, floor(copies)::BIGINT AS whole, copies - floor(copies) AS p,
  (('0x' || substr(md5(concat_ws('|', 'mix', doc_id, size)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
q AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM r),
c0 AS (SELECT *, least(floor(rank / (1 + rank) * 1125899906842624.0::DOUBLE), 1125899906842623.0::DOUBLE)::BIGINT AS k, false AS got,
  target - sum(whole * size) OVER (PARTITION BY source) AS room FROM q)"""
    for n in range(1, rounds + 1):
        sql += f""",
a{n} AS (SELECT *, NOT got AND k IS NOT NULL AND size <= room AS fits FROM c{n - 1}),
b{n} AS (SELECT *, fits AND sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source, fits ORDER BY k) <= room AS new FROM a{n}),
c{n} AS (SELECT * EXCLUDE (fits, new, got, room), got OR new AS got,
  room - sum(CASE WHEN new THEN size ELSE 0 END) OVER (PARTITION BY source) AS room FROM b{n})"""
    return sql + f"""
SELECT doc_id, size, words AS source_size, target, (whole + got::BIGINT) * size AS taken, whole + got::BIGINT AS copies FROM c{rounds}"""


@query("op12_source_mix", _pareto_sql())
def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return pareto.mix(table(spark, folder, "documents"))
