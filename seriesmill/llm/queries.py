"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seriesmill.llm import (chat, digests, importance, langid, mixing, packing, periods, phrases, shards, simhash, substrings,
                            urlrules, winnow)
from seriesmill.llm.common import documents, numbered, ready

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def empty_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


# --- 1: language ------------------------------------------------------------------------

@query("op1_rank_order_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by profiles learnt from those that are not held out."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn(
        "held_out", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)
    profiles = langid.learn(docs.where(~F.col("held_out")))
    return langid.identify(docs, profiles, ["doc_id", "held_out"])


# --- 2: chat formatting -----------------------------------------------------------------

CONTROL_TEXT = r"\### Assistant: </turn> ok"


def escapes(text: str, role: bool = False) -> str:
    """SQL: how many backslashes the template puts into a text."""
    colons = f" + length({text}) - length(replace({text}, ':', ''))" if role else ""
    return (f"(length({text}) - length(replace({text}, '\\', ''))){colons} + (length({text}) - length(replace({text}, '</turn>', ''))) // 7"
            f" + length({text}) - length(regexp_replace({text}, '#{{3,}}', '', 'g'))")


@query("op2_chat_template", f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, r, '{CONTROL_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r)),
s AS (SELECT *, 15 + length(role) + {escapes('role', True)} + length(text) + {escapes('text')} AS written FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(written) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that is full of control strings, as written and read back."""
    spark = ready(spark)
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                   "conv_id bigint, turn bigint, role string, text string")
    records = given.unionByName(tricky).select(
        "conv_id", "turn", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    return chat.digests(chat.formatted(chat.turns(records, "conv_id", "turn", "record")))


# --- 3: document fingerprints ---------------------------------------------------------

@query("op3_document_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose end comes from the next document.

    Every row gives one row.  Rows are in the order of their id (null first) and a hash of their
    text, equal rows next to each other; the row after the last is the first.
    """
    docs = documents(spark, sf_dir, "doc_id", "text").select("doc_id", empty_if_null("text").alias("text")).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("mark"), "text")
    name = ["id", "none", "mark"]  # of a text: rows that agree in these are equal
    order, n = numbered(docs.select(*name, F.char_length("text").alias("n")), [F.col("none").desc(), F.col("id"), F.col("mark")], "row")
    # each row gives its head to the one before it: links by row number, on names only
    links = order.select(*[F.col(c).alias(f"giver_{c}") for c in name], F.pmod(F.col("row") - 1, F.lit(max(n, 1))).alias("row")).join(
        order.select(*[F.col(c).alias(f"taker_{c}") for c in name], F.floor(F.col("n") / 4).cast("int").alias("want"), "row"), "row")
    same = F.col("n") - F.floor(F.col("n") / 4).cast("int")  # what an edit leaves of a text
    # a name has one text, however many rows: the joins give as many rows as there are links
    own = docs.select(*name, "text", F.char_length("text").alias("n"), winnow.winnowed(F.col("text")).alias("packed")).select(
        *name, "text", winnow.carried(F.col("packed"), F.col("n"), same).alias("carried")).dropDuplicates(name)
    # the fingerprint and how many grams an edit leaves travel as one column: both readers of the
    # shuffle then need the same columns and share it, so no text is fingerprinted or sent twice
    given = own.join(links.hint("merge"), [F.col(c) == F.col(f"giver_{c}") for c in name]).select(
        *[f"taker_{c}" for c in name], "want", F.expr("left(text, want)").alias("head"), F.col("carried.h").alias("next"))
    met = own.hint("merge").join(given, [F.col(c) == F.col(f"taker_{c}") for c in name]).withColumn(
        "doc_id", F.when(~F.col("none"), F.col("id")))
    edited = met.select(
        "doc_id", F.char_length("text").alias("n"), F.col("carried.h").alias("h"), winnow.places(F.col("carried")).alias("p"),
        F.col("carried.stay").alias("stay"), "next", "want",
        F.concat(F.expr("left(text, char_length(text) - want)"), F.col("head")).alias("edited"))
    whole = edited.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "h", "p", "stay", "next",
        winnow.amended_packed(F.array().cast("array<bigint>"), F.col("n") - F.col("want"), F.col("edited")).alias("later"))
    kept = lambda c: F.slice(c, F.lit(1), F.col("stay"))
    both = whole.withColumns({"edited_h": F.concat(kept("h"), winnow.hashes(F.col("later"))),
                              "edited_p": F.concat(kept("p"), winnow.positions(F.col("later")))})
    return both.select(
        "doc_id", "n_chars", "edited_sha256", winnow.spelled(F.col("h"), F.col("p")).alias("fingerprint"),
        winnow.spelled(F.col("edited_h"), F.col("edited_p")).alias("edited_fingerprint"),
        winnow.likeness(F.col("h"), F.col("edited_h")).alias("near_edited"),
        winnow.likeness(F.col("h"), F.col("next")).alias("near_next"))


# --- 4: sharding ------------------------------------------------------------------------

@query("op4_feistel_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards whose row counts differ by one at most."""
    docs = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(empty_if_null("text")).alias("text_crc32"))
    placed = shards.sharded(docs, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


# --- 5: near-duplicates -----------------------------------------------------------------

@query("op5_simhash_pivots")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash of every document and the component of fingerprints it is linked to."""
    groups = simhash.near_groups(documents(spark, sf_dir, "doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


# --- 6: mixing --------------------------------------------------------------------------

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights 3, 1 and 2 by their integrals: the first falls, the second stays, the third rises.
CURRICULUM = (mixing.Schedule(((0.0, 4.5), (1.0, 1.5))), mixing.Schedule(((0.0, 1.0), (1.0, 1.0))),
              mixing.Schedule(((0.0, 1.0), (0.5, 2.0), (1.0, 3.0))))


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


@query("op6_source_mix")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document and where in training it stands."""
    docs = documents(spark, sf_dir, "doc_id", "source", "text").select(
        "doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("mark"))
    plan = mixing.planned(docs, F.xxhash64("doc_id", "mark", F.lit(6)), [F.col("doc_id"), F.col("size")],
                          CURRICULUM, share=1.5, cap=2)
    return plan.repartitionByRange(F.get("positions", F.lit(0)), "doc_id").sortWithinPartitions(
        F.get("positions", F.lit(0)), "doc_id").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        "positions")


# --- 7: quality -------------------------------------------------------------------------

@query("op7_importance_resampling")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log importance of every document and whether Gumbel top-k draws it."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return importance.selected(docs, labels).select("doc_id", "log_weight", "noise", "key", "kept")


# --- 8: URL rules -----------------------------------------------------------------------

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


@query("op8_url_rules", """
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that fits every page's URL best, and its verdict."""
    pages = ready(spark).read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urlrules.judged(pages, spark.createDataFrame(list(RULES), "host string, path string, verdict string"))


# --- 9: exact dedup ---------------------------------------------------------------------

@query("op9_digest_index", """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts, decided against a digest index that starts empty."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    decided = digests.decide(docs, digests.new_index(spark, buckets=64))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


# --- 10: packing ------------------------------------------------------------------------

@query("op10_grouped_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    return packing.pack_documents(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("bigint").alias("offset"))


# --- 11: periodic runs ------------------------------------------------------------------

def tailed() -> Column:
    """The texts' words with a periodic tail for one document in ten, decided by its id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.when(h % 10 == 0, F.floor(h / 10).cast("bigint"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal runs of words in every document, one in ten of which gets a periodic tail first."""
    docs = documents(spark, sf_dir, "doc_id", "text").select("doc_id", "text", tailed().alias("tail"))
    runs = F.col("runs")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return periods.collapsed(docs, tail="tail").withColumn("best", periods.strongest(runs)).select(
        "doc_id", F.size(runs).cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


# --- 12: collocations -------------------------------------------------------------------

_lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op12_son_collocations", f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate({_lower}, '.,;:!?' || chr(11) || chr(12) || chr(13), repeat(chr(10), 9)), chr(10))) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split(translate(piece, chr(9), ' '), ' '), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, unnest(ws) AS phrase, 1 AS words FROM w
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM w
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])), 3 FROM w),
c AS MATERIALIZED (SELECT lang, phrase, words, count(*) AS f, string_split(phrase, ' ') AS s, lang || chr(10) || phrase AS name FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM c WHERE words = 1 GROUP BY 1),
k AS (SELECT *, f AS a FROM c WHERE words > 1 AND f >= 10),
cuts AS (
  SELECT k.lang, k.phrase, k.words, k.s, k.a, cut, l.f AS l, r.f AS r, CAST(1000000::HUGEINT * k.a * k.a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, words)) AS cut FROM k) k
  JOIN c l ON l.name = k.lang || chr(10) || array_to_string(k.s[1:cut], ' ')
  JOIN c r ON r.name = k.lang || chr(10) || array_to_string(k.s[cut + 1:], ' ')),
b AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, phrase, max(f) AS most FROM (
  SELECT lang, s[1] || ' ' || s[2] AS phrase, f FROM k WHERE words = 3 UNION ALL SELECT lang, s[2] || ' ' || s[3], f FROM k WHERE words = 3) GROUP BY ALL),
left_ AS (SELECT b.* FROM b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase WHERE coalesce(100 * i.most < 50 * b.a, TRUE))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(t.n AS BIGINT) AS n, score
FROM left_ JOIN t USING (lang) QUALIFY rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words of each language."""
    return phrases.collocations(documents(spark, sf_dir, "text", "lang"))


# --- 13: repeated substrings ------------------------------------------------------------

@query("op13_suffix_repeats")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its bytes in strings of 400 bytes that occur elsewhere too."""
    left = substrings.without_repeats(documents(spark, sf_dir, "doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["begin"])
    return left.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))
