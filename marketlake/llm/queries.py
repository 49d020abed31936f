"""One query per training-data operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlake.llm import chat, licenses, lines, merkle, mixing, neardup, neighbours, pieces, repeats, secrets, sketches, spelling, toxicity
from marketlake.llm.common import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINE_DEDUP_SQL = f"""
lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT *, translate(trim(line, {_SPACE_SQL}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.line, k.i, (r.key IS NOT NULL AND k.doc_id <> r.keeper) AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
"""
ORACLES["op1_line_dedup"] = f"""
WITH {LINE_DEDUP_SQL}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of ids, their digest (comma-joined), and whether they decode to the text."""
    found = pieces.add_pieces(table(spark, sf_dir, "documents"), PIECE_MODEL)
    return found.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("piece_ids", ",").cast("binary"), 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id bigint, turn bigint, role string, text string"
    )
    return chat.conversation_digests(given.unionByName(added))


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", mixing.word_count().alias("size")
    )
    mixed = mixing.mix(units)
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
    )


@query
def op10_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, threshold=(85, 100))


@query
def op5_multiprobe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_versions(table(spark, sf_dir, "documents"))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: a top directory for each source, 100 ids in a directory, each 25th id a license file."""
    documents = table(spark, sf_dir, "documents")
    hundred, ten_thousand = F.expr("doc_id div 100"), F.expr("doc_id div 10000")
    name = F.when(F.col("doc_id") % 25 == 0, F.concat(F.lit("LICENSE."), F.col("doc_id"))).otherwise(
        F.concat(F.col("doc_id"), F.lit(".txt"))
    )
    path = F.concat_ws("/", "source", ten_thousand, hundred, name)
    found = licenses.scan_licenses(documents.select("doc_id", path.alias("path"), "text"), key="doc_id")
    return found.select("doc_id", "path", "own_license", F.round("cosine", 6).alias("cosine"), "license", "inherited_from")


# Unsigned CRC-32 of a list of byte values, with its table of 256 entries built by the rule.
CRC_SQL = """
crc_rule AS (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_rule)
"""


def crc_sql(values: str) -> str:
    """CRC-32 of a list expression, where ``crc_table`` is joined."""
    return f"""xor(list_reduce(list_prepend(4294967295, {values}),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def tampered() -> Column:
    """Documents whose n_chars the manifest query finds one higher than recorded."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document against its manifest, after one is added to n_chars where 7 divides crc32(doc_id)."""
    documents = table(spark, sf_dir, "documents")

    def leaf(n_chars: Column) -> Column:
        return merkle.row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    recorded = leaf(F.col("n_chars"))
    found = F.when(tampered(), leaf(F.col("n_chars") + 1)).otherwise(recorded)
    return merkle.manifest(documents, recorded, found)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE {CRC_SQL},
leaves AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN {crc_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 7 = 0
              THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS found
  FROM documents, crc_table),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
tree AS (
  SELECT lang, 0 AS level, i, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, any_value(level) + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY lang, i // 2),
subroots AS (
  SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM tree WHERE n = 1),
crown AS (
  SELECT 0 AS level, i, d, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM crown WHERE n > 1 GROUP BY i // 2),
steps AS (
  SELECT p.lang, p.i, t.level AS level, (p.i >> t.level) & 1 AS slot, s.d AS d
  FROM placed p JOIN (SELECT DISTINCT lang, level FROM tree WHERE n > 1) t ON p.lang IS NOT DISTINCT FROM t.lang
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = t.level AND s.i = xor(p.i >> t.level, 1)
  UNION ALL
  SELECT p.lang, p.i, 1000 + t.level, (r.i >> t.level) & 1, s.d
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
  CROSS JOIN (SELECT DISTINCT level FROM crown WHERE n > 1) t
  LEFT JOIN crown s ON s.level = t.level AND s.i = xor(r.i >> t.level, 1)),
paths AS (
  SELECT lang, i, list(CASE WHEN d IS NULL THEN '' WHEN slot = 1 THEN 'l' || d ELSE 'r' || d END ORDER BY level) AS path,
         sha256(coalesce(string_agg(d, '' ORDER BY level), '')) AS proof_sha256
  FROM steps GROUP BY lang, i)
SELECT p.doc_id, p.leaf, r.d AS subroot, c.d AS root, coalesce(w.proof_sha256, sha256('')) AS proof_sha256,
       list_reduce(list_prepend(p.found, coalesce(w.path, [])), lambda a, x: sha256(
         CASE WHEN x = '' THEN a WHEN x[1] = 'l' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root,
       list_reduce(list_prepend(p.found, coalesce(w.path, [])), lambda a, x: sha256(
         CASE WHEN x = '' THEN a WHEN x[1] = 'l' THEN x[2:] || a ELSE a || x[2:] END)) = c.d AS verified
FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
JOIN crown c ON c.n = 1
LEFT JOIN paths w ON p.lang IS NOT DISTINCT FROM w.lang AND p.i = w.i
"""


@query
def op12_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


LETTERS = "A-Za-z\u00C0-\u00FF"
SHORTEST = 7  # code points of a word
SLIP = 31  # a run loses a letter where this divides its checksum


def spelt_words(documents: DataFrame) -> DataFrame:
    """``word, n``: runs of letters of whole texts, one letter taken out of some, lower-cased, found at least twice."""
    found = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{SHORTEST},}})"), F.lit(1))
    runs = documents.select("doc_id", F.explode(found).alias("run"))
    run = F.translate("run", _UPPER, _LOWER)
    runs = runs.select("doc_id", run.alias("run"), F.length("run").alias("size"))
    spelt = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.withColumn("_h", F.crc32(spelt.cast("binary")))
    at = (F.col("_h") % F.col("size")).cast("int")
    slipped = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("size")))
    words = runs.select(F.when(F.col("_h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelt_words(table(spark, sf_dir, "documents")), times=10)


_BYTES_SQL = """flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
    ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END))"""
ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE {CRC_SQL},
runs AS (
  SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[{LETTERS}]{{{SHORTEST},}}')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (SELECT run, n, length(run) AS size, {crc_sql(_BYTES_SQL)} AS h FROM runs, crc_table),
spelt AS (
  SELECT CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, (h % size)::INT) || substr(run, (h % size)::INT + 2) ELSE run END
         AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= 2),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b
  ON a.head = b.head AND a.tail = b.tail AND a.i = b.i WHERE a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.head || c.tail = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.head || c.tail = w.word),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near
  FROM near),
judged AS (
  SELECT w.word, CASE WHEN r.n >= 10 * w.n THEN r.near END AS form, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.r = 1),
chains AS (
  SELECT word, word AS root FROM judged
  UNION ALL
  SELECT c.word, j.form FROM chains c JOIN judged j ON c.root = j.word WHERE j.form IS NOT NULL)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n
FROM judged j JOIN (
  SELECT c.word, c.root FROM chains c JOIN judged k ON c.root = k.word WHERE k.form IS NULL) c ON j.word = c.word
"""
