"""Benchmark decontamination by word windows, native (operator 6).

Text has A-Z lower-cased and is cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. The
windows of an item are its 13 consecutive words each, or all its words if it has fewer.
Documents emit their windows of the lengths that occur among the items, and an equi-join
on the window's words finds the hits, so each hit is exact. The item side is a broadcast
hash set while its windows number ``BROADCAST_WINDOWS`` at most (about 100 bytes each);
beyond that it is an ordinary shuffled join. Only hits are shuffled, never texts.

Defined results: a null or empty text has no words and is not contaminated; null or empty
items have no windows; without items nothing is hit; null doc_ids stay; rows with equal
doc_id and text get equal results; other columns are ignored by ``contamination`` and
kept by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.sources.staging import stage

WIDTH = 13
BROADCAST_WINDOWS = 500_000

# helper columns beside a caller's own
_ID, _HASH, _HIT = "__window_doc_id", "__window_hash", "__window_hit"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAPS_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Normalised words; empty for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _GAPS), "")


def windows_of(words: Column, width: int) -> Column:
    """(position from 1, width, words joined by a space) of every window."""
    return F.when(
        F.size(words) >= width,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - F.lit(width - 1)),
            lambda at: F.struct(
                at.alias("at"),
                F.lit(width).alias("width"),
                F.concat_ws(" ", F.slice(words, at, F.lit(width))).alias("gram"),
            ),
        ),
    )


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """item_id, width and gram of every distinct window of every item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    return (
        items.withColumn("at", F.explode(starts))
        .select("item_id", "width", F.expr("concat_ws(' ', slice(words, at, width))").alias("gram"))
        .distinct()
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        words_of(F.col("text")).alias("words"),
    )


def _hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, at, width, gram of every document window that an item has."""
    grams = items.select("gram").distinct()
    widths = sorted(row.width for row in items.select("width").distinct().collect())  # ``WIDTH`` values at most
    if items.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        grams = F.broadcast(grams)
    keyed = _keyed(docs)
    parts = [F.coalesce(windows_of(F.col("words"), w), F.array()) for w in widths] or [
        F.lit(None).cast("array<struct<at:int,width:int,gram:string>>")
    ]
    emitted = keyed.select("doc_id", "text_hash", F.explode(F.concat(*parts)).alias("w"))
    return emitted.select("doc_id", "text_hash", "w.*").join(grams, "gram", "left_semi")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash, hit (1-based positions)."""
    items = item_windows(benchmark, width)
    # the windows of all documents are made once; hits alone are written
    hits = stage(_hits(docs, items), "hits")
    key = ["doc_id", "text_hash"]
    # a window has a bounded number of words, and a document's positions are its own row
    places = hits.groupBy(key).agg(F.collect_set(F.struct("at", "width")).alias("at"))
    places = places.select(
        *key,
        F.array_distinct(F.flatten(F.transform("at", lambda x: F.sequence(x.at, x.at + x.width - 1)))).alias("hit"),
    )
    named = hits.select(*key, "gram").distinct().join(items.select("gram", "item_id"), "gram")
    names = named.select(*key, "item_id").distinct().groupBy(key).agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    rows = _keyed(docs).select(*key, F.size("words").alias("n_words"))

    def attach(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
        right = right.select(F.col("doc_id").alias(_ID), F.col("text_hash").alias(_HASH), column)
        same = left.text_hash.eqNullSafe(right[_HASH]) & left.doc_id.eqNullSafe(right[_ID])
        return left.join(right, same, "left").drop(_ID, _HASH)

    both = attach(attach(rows, places, "hit"), names, "ids")
    n_hit = F.coalesce(F.size("hit"), F.lit(0)).cast("bigint")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return both.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.greatest(n_hit, F.lit(0)).alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        "text_hash",
        F.coalesce("hit", F.array().cast("array<int>")).alias("hit"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WIDTH) -> DataFrame:
    """The columns of ``docs`` without contaminated documents, or without the words that are hit.

    With ``remove="spans"`` the text of a document with hits becomes its other words,
    in their own case, joined by one space; other texts stay as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    found = contamination(docs, benchmark, width).where("contaminated" if remove == "documents" else "n_hit > 0")
    found = found.select(F.col("doc_id").alias(_ID), F.col("text_hash").alias(_HASH), F.col("hit").alias(_HIT))
    found = found.dropDuplicates([_ID, _HASH])
    same = F.xxhash64("text").eqNullSafe(F.col(_HASH)) & F.col("doc_id").cast("bigint").eqNullSafe(F.col(_ID))
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    cased = F.array_remove(F.split(F.coalesce("text", F.lit("")), _GAPS_CASED), "")
    numbered = F.filter(cased, lambda word, at: ~F.array_contains(_HIT, (at + 1).cast("int")))
    text = F.when(F.col(_HIT).isNull(), F.col("text")).otherwise(F.concat_ws(" ", numbered))
    joined = docs.join(found, same, "left")
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


SQL = f"""
WITH doc AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, words, least(len(words), {WIDTH}) AS width FROM (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM benchmark) WHERE len(words) > 0
), item_window AS (
  SELECT DISTINCT item_id, width, array_to_string(words[pos : pos + width - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS pos FROM item)
), doc_window AS (
  SELECT doc_id, pos, width, array_to_string(words[pos : pos + width - 1], ' ') AS gram
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS pos
        FROM doc, (SELECT DISTINCT width FROM item) WHERE len(words) >= width)
), hit AS (
  SELECT doc_id, pos, width, gram FROM doc_window WHERE gram IN (SELECT gram FROM item_window)
), place AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + width)) AS p FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit JOIN item_window USING (gram)) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN place USING (doc_id) LEFT JOIN named USING (doc_id)
"""
