"""Registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import corpus_pipeline
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe, embedding, exact, html_text, lines, packing, periodic, pieces, pii, simhash, substring, toxicity, trie
from .common import freed, table, tokenizer_path, written

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def registered(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[run.__name__] = run
    return run


@registered
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents by SimHash."""
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@registered
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@registered
def op3_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors by cosine."""
    return embedding.embedding_groups(table(spark, sf_dir, "embeddings"))


@registered
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)"""


@registered
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that occur on many sites."""
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLE["op5_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM lines),
spread AS (
  SELECT key, min((doc_id, pos)) AS first FROM keyed
  WHERE key <> '' GROUP BY key
  HAVING count(DISTINCT source) >= CASE WHEN length(key) < 20 THEN 10 ELSE 5 END),
judged AS (
  SELECT k.doc_id, k.line, k.pos, s.key IS NOT NULL AND (k.doc_id, k.pos) <> s.first AS gone
  FROM keyed k LEFT JOIN spread s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@registered
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    path = tokenizer_path("byte_bpe_50k.json")
    return coded(bpe.encode(table(spark, sf_dir, "documents"), path, and_decode=True))


def coded(both: DataFrame) -> DataFrame:
    """Digests of ids and of the text decoded from them."""
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        decimal_sha256("ids").alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


@F.pandas_udf(T.StringType())
def decimal_sha256(ids: pd.Series) -> pd.Series:
    """SHA-256 of the ids in decimal, joined by commas."""
    numbers = [np.frombuffer(i, "<u4") for i in ids]
    texts = bpe.decimals(1 + max((int(n.max()) for n in numbers if len(n)), default=-1))
    return pd.Series([hashlib.sha256(texts.join(n)[:-1]).hexdigest() for n in numbers])


@registered
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.toxicity(docs, model).select(
        "doc_id", toxicity.is_held_out("doc_id").alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@registered
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left without repeated passages."""
    parsed = substring.repeated_passages(table(spark, sf_dir, "documents"))
    whole, nothing = F.lower(F.hex("words_sha256")), F.sha2(F.lit(""), 256)
    return parsed.select(
        "doc_id", "n_words", "n_removed",
        F.when(F.col("n_removed") == 0, whole).when(F.col("n_removed") == F.col("n_words"), nothing)
        .otherwise(F.sha2("kept", 256)).alias("kept_sha256"),
    )


@registered
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@registered
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
    )


BLANKS = " \t\n\x0b\x0c\r"


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth document, by a hash of its id, repeats itself from a word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS))
    chosen = (F.col("h") % 10 == 0) & (F.col("trimmed") != "")
    words = F.split("trimmed", r"[\x20\x09-\x0D]+")
    parts = docs.select("doc_id", "text", h.alias("h"), trimmed.alias("trimmed")).select(
        "doc_id", "text", F.expr("h div 10").alias("g"), F.when(chosen, words).alias("w")
    ).withColumn("n", F.size("w")).withColumn("a", F.when(F.col("w").isNotNull(), F.expr("cast(g % n as int)")))
    parts = parts.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr(
        "array_join(concat(slice(w, 1, a),"
        " slice(flatten(array_repeat(slice(w, a + 1, p), cast((n - a + p - 1) div p as int))), 1, n - a)), ' ')"
    )
    return parts.select("doc_id", F.when(F.col("w").isNotNull(), again).otherwise(F.col("text")).alias("text"))


@registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which are made to repeat themselves."""
    found = periodic.periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    # The greatest quotient of whole numbers, compared by products; the first of equal ones stays.
    more = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(more(y, x), y).otherwise(x))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines_ = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines_, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"),
    )


# CRC-32 of a number in decimal, as SQL over the column ``{0}``.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({0}::VARCHAR, ''),
  lambda d: [ascii(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))))"""

# Every pair of equal 5-grams of a document is a link; neighbouring links of one distance are a stretch
# with that period.
ORACLE["op11_periodic_runs"] = f"""
WITH hashed AS (
  SELECT doc_id, {_CRC32.format("doc_id")} AS h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS o
  FROM documents),
placed AS (SELECT *, len(o) AS n, h // 10 AS g, CASE WHEN len(o) > 0 THEN (h // 10) % len(o) END AS a FROM hashed),
planted AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(n), lambda i: o[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1])
    ELSE o END AS w FROM placed),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM planted),
gram AS (
  SELECT doc_id, i, [word, lead(word, 1) OVER d, lead(word, 2) OVER d, lead(word, 3) OVER d, lead(word, 4) OVER d] AS gram,
         lead(i, 4) OVER d AS whole
  FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
named AS (SELECT doc_id, i, md5(gram::VARCHAR) AS gram FROM gram WHERE whole IS NOT NULL),
link AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM named x JOIN named y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM link)
  GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
run AS (
  SELECT * FROM stretch s WHERE NOT EXISTS (
    SELECT 1 FROM stretch t WHERE t.doc_id = s.doc_id AND t.q < s.q AND t.start <= s.start
      AND t.start + t.length >= s.start + s.length)),
found AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines
  FROM run GROUP BY doc_id),
best AS (
  SELECT doc_id, start, length, q AS period FROM run
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / q DESC, start, q) = 1),
dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM run),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN found USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def rebuilt(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, position, digest, n_words) with openings borrowed.

    By a hash of its id a conversation takes none to three turns of the conversation whose id is the
    next lower multiple of twenty in place of as many of its own, or fewer where that one is shorter.
    """
    base, h = F.expr("conv_id - conv_id % 20"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    convs = turns.where("position = 0").select("conv_id", base.alias("base"), h.alias("h"))
    heads = turns.where("conv_id % 20 = 0 and position < 3").withColumnRenamed("conv_id", "base")
    borrowed = convs.join(heads, "base").where("position < h")
    lent = heads.groupBy("base").agg(F.count(F.lit(1)).alias("lent"))
    # Conversations whose own turns move up, because fewer are lent than they leave out.
    short = convs.join(lent, "base", "left").select(
        "conv_id", (F.col("h") - F.least("h", F.coalesce("lent", F.lit(0)))).alias("short")
    ).where("short > 0")
    own = turns.where(F.col("position") >= h).join(short, "conv_id", "left")
    own = own.withColumn("position", F.col("position") - F.coalesce("short", F.lit(0)))
    columns = ["conv_id", "position", "digest", "n_words"]
    return borrowed.select(*columns).unionByName(own.select(*columns))


@registered
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the conversations with borrowed openings."""
    digests = written(trie.turn_digests(table(spark, sf_dir, "conversations")), "digests")
    turns = written(trie.numbered(digests), "turns")
    freed(digests)
    return trie.trie(written(rebuilt(turns), "rebuilt"), turns.where("position = 0").select("conv_id"))


ORACLE["op12_prefix_trie"] = f"""
WITH turn AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, left(coalesce(text, ''), 64) AS head,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, {_CRC32.format("conv_id")} % 4 AS h,
         list(digest ORDER BY turn NULLS FIRST, role, head, digest) AS k,
         list(n_words ORDER BY turn NULLS FIRST, role, head, digest) AS w
  FROM turn GROUP BY conv_id),
conv AS (
  SELECT c.conv_id, list_concat(coalesce(b.k[1:c.h], []), c.k[c.h + 1:]) AS k, list_concat(coalesce(b.w[1:c.h], []), c.w[c.h + 1:]) AS w
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
path AS (SELECT conv_id, k, w, unnest(range(len(k) + 1)) AS depth FROM conv),
node AS (
  SELECT depth, md5(array_to_string(k[1:depth], ',')) AS p, any_value(md5(array_to_string(k[1:depth - 1], ','))) AS up,
         min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(CASE WHEN depth = 0 THEN 0 ELSE w[depth] END) AS v,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(k) = depth) AS ends
  FROM path GROUP BY depth, p),
child AS (SELECT depth - 1 AS depth, up AS p, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (depth, p)),
above AS (
  SELECT n.v, n.n_children, k, unnest(range(n.depth + 1)) AS depth FROM full_ n JOIN conv USING (conv_id)),
tree AS (
  SELECT depth, md5(array_to_string(k[1:depth], ',')) AS p, sum(v) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM above GROUP BY depth, p)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM full_ n JOIN tree USING (depth, p) LEFT JOIN node u ON u.depth = n.depth - 1 AND u.p = n.up"""



@registered
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by a SentencePiece model."""
    path = tokenizer_path("piece_bpe_32k.model")
    return coded(pieces.encode(table(spark, sf_dir, "documents"), path, and_decode=True))


@registered
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, one after the other."""
    return corpus_pipeline.run(spark, sf_dir)
