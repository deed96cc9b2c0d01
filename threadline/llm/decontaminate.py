"""Benchmark decontamination as a prefix-filtered set join, in built-in functions only.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is
one window).  A document contains a window only if it contains each of its
words, so with the words of a window ordered by rarity (occurrences over all
documents) its rarest word alone is the necessary prefix: only places of that word
in a document are candidates.  The place of the word in the window and the length of the
document bound where the window can lie; the words there are then compared with
the window one by one.  A window text that many items share is joined once.

The benchmark side is broadcast after its rows have been counted; each document then carries one
sentinel word (NUL, which no word can hold), so that a single pass gives its row and word count
besides its matches.  Beyond ``BROADCAST_WINDOWS`` the same join runs as a shuffle join on the rarest
word, with just the words around each candidate place: words are counted before they meet the
benchmark's words, places are salted so that a frequent rarest word is spread over ``SALTS`` tasks, and
the rows of the documents come from the documents themselves.

Defined cases: null or empty texts have no words; identical (id, text) rows get a
row each; a null item id counts as the empty string; repeated items count once;
without items nothing is contaminated; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadline.llm.common import checkpointed, documents, drop_rows

WINDOW = 10
BROADCAST_WINDOWS = 200_000
#: Parts of each rarest word in the shuffle join; at most this many rarest words are broadcast to leave other places out before it.
SALTS, BROADCAST_ANCHORS = 32, 500_000
SENTINEL = "\0"
#: The separators of the word rule.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; other letters unchanged."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is the same as translate() where all characters are ASCII, and much cheaper
    t = F.when(t.rlike("[^\\x00-\\x7F]"), F.translate(t, UPPER, LOWERED)).otherwise(F.lower(t))
    return F.array_remove(F.split(t, SEPARATORS), "")


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """Distinct windows with the items that hold them: win, len, items."""
    w = (items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w"))
         .where(F.size("w") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return (w.select("item", F.explode(starts).alias("s"), "w")
            .select("item", F.slice("w", F.col("s"), F.lit(width)).alias("win"))
            .groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))
            .withColumn("len", F.size("win")))


def anchored(win: DataFrame, docs: DataFrame, text_col: str = "text", small: bool = True) -> DataFrame:
    """Windows with their rarest word over all documents and its first place."""
    vocab = win.select(F.explode("win").alias("word")).distinct()
    seen = docs.select(F.explode(words(F.col(text_col))).alias("word"))
    if small:
        counts = seen.join(F.broadcast(vocab), "word").groupBy("word").agg(F.count("*").alias("n"))
    else:  # one row per word and task is shuffled, not one per occurrence
        counts = seen.groupBy("word").agg(F.count("*").alias("n")).join(vocab, "word")
    ranked = (win.select("win", F.posexplode("win").alias("at", "word")).join(counts, "word", "left")
              .groupBy("win").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("rarest")))
    return win.join(ranked, "win").select("win", "len", "items", F.col("rarest.word").alias("anchor"),
                                          F.col("rarest.at").alias("at"))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            width: int = WINDOW) -> DataFrame:
    """A row per document (win is null) and one per occurrence of a window: place 0-based."""
    spark = docs.sparkSession
    win = checkpointed(windows(items, text_col="text", width=width))
    small = win.count() <= BROADCAST_WINDOWS
    table = checkpointed(anchored(win, docs, text_col, small))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), words(F.col(text_col)).alias("w"),
                      F.xxhash64(text_col).alias("h"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).alias("b"))
    keyed = own.select("doc_id", "h", "b", F.size("w").alias("n_words"), "w")
    start = F.col("p") - F.col("at")
    inside = (start >= 0) & (start + F.col("len") <= F.col("n_words"))  # positional and length bounds

    def same(first):  # the words at the place, in a slice of the text that begins at word ``first``
        return F.slice("w", F.greatest(start - first + 1, F.lit(1)), F.col("len")) == F.col("win")

    def found(rows):
        return rows.select("doc_id", "h", "b", "n_words", F.when(F.col("win").isNotNull(), start).alias("start"), "len", "items")

    if small:
        none = spark.range(1).select(*(F.lit(SENTINEL if f.name == "anchor" else None).cast(f.dataType).alias(f.name)
                                       for f in table.schema))
        placed = (keyed.withColumn("w", F.concat("w", F.array(F.lit(SENTINEL))))
                  .select("doc_id", "h", "b", "n_words", "w", F.posexplode("w").alias("p", "anchor")))
        return found(placed.join(F.broadcast(table.unionByName(none)), "anchor")
                     .where(F.col("win").isNull() | (inside & same(F.lit(0)))))

    placed = keyed.select("doc_id", "h", "b", "n_words", "w", F.posexplode("w").alias("p", "anchor"))
    rarest = checkpointed(table.select("anchor").distinct())
    if rarest.count() <= BROADCAST_ANCHORS:
        placed = placed.join(F.broadcast(rarest), "anchor", "left_semi")
    first = F.greatest(F.col("p") - (width - 1), F.lit(0))
    placed = (placed.withColumn("w", F.slice("w", first + 1, F.lit(2 * width - 1)))
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "h", "p"), F.lit(SALTS)).cast("int")))
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = found(placed.join(salted, ["anchor", "salt"]).where(inside & same(first)))
    rows = keyed.select("doc_id", "h", "b", "n_words", *(F.lit(None).cast(hits.schema[c].dataType).alias(c) for c in ("start", "len", "items")))
    return rows.unionByName(hits)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  width: int = WINDOW) -> DataFrame:
    """Per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.col("start").isNotNull()
    per = (matches(docs, items, id_col, text_col, width)
           .groupBy("doc_id", "h", "b").agg(
               F.max("n_words").cast("long").alias("n_words"), F.sum(F.when(hit, 0).otherwise(1)).alias("copies"),
               F.array_sort(F.collect_set(F.when(hit, F.struct(F.col("start").alias("s"), (F.col("start") + F.col("len")).alias("e"))))).alias("spans"),
               F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_list")))
    # spans sorted by start: add what each one reaches beyond the furthest end so far
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(a["end"], x["s"].cast("long")))).alias("n"),
                              F.greatest(a["end"], x["e"].cast("long")).alias("end")), lambda a: a["n"])
    return (per.select("doc_id", "n_words", covered.alias("n_hit"), "item_list",
                       F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
            .select("doc_id", "n_words", "n_hit", F.size("item_list").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "item_list"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")))


def clean_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, columns unchanged."""
    bad = matches(docs, items, id_col, text_col).where(F.col("start").isNotNull())
    no_id = F.lit(2**63 - 1)
    bad = bad.select(F.coalesce("doc_id", no_id).alias("id"), "h").distinct()
    return drop_rows(docs, [F.coalesce(F.col(id_col).cast("long"), no_id), F.xxhash64(text_col)], bad, bad.limit(0))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM iw WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM dw CROSS JOIN (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)
), hits AS (
  SELECT p.doc_id, p.s, p.n, i.item FROM places p JOIN wins i ON p.win = i.win AND p.n = i.n
), covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS k FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""
