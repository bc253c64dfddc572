"""Benchmark decontamination by a prefix-filtered join, in DataFrame functions only.

An item's windows are runs of ``WINDOW`` of its words (all of them, if it has fewer). A window is contained in a text
where all its shingles follow one another, so its rarest shingle is prefix enough: only places of that shingle are
candidates, the window must fit between the text's first and last word, and then every shingle has to be in its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import written
from foliant.scale import cut_lineage, small_side

WINDOW, SHINGLE = 10, 3
#: Fixed value: what a word is, before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Shingles of all items that are still sent to every task (about 100 bytes each); more are joined by a shuffle.
MAX_SENT = 300_000


def words_of(text: str) -> Column:
    """Array of the words of a column, A-Z lower-cased; null has none."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # in ASCII, lower() changes A-Z alone and is several times as fast
    lowered = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def shingle_at(words: Column, place: Column, size: int) -> Column:
    """``size`` words from ``place`` (0 is the first), joined by a space, which no word holds; null where they end before."""
    parts = [F.get(words, place)]
    for i in range(1, size):
        parts += [F.lit(" "), F.get(words, place + i)]
    return F.concat(*parts)


def shingles_of(words: Column, size: int) -> Column:
    """All runs of ``size`` words of a short array, in order."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    return F.transform(places, lambda i: shingle_at(words, i, size))


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (``item``, ``window``: array of words) of all items; an item without words has none."""
    words = items.select(F.col(id_col).alias("item"), words_of(text_col).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, WINDOW))).alias("window")).distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``content`` (digest of the text), ``n_words``, ``n_hit`` and ``items`` (sorted as strings) of every row.

    A word is hit if it lies in a place where a window of an item occurs. Null, empty and wordless texts have no words
    and no hits, items without words no windows. Items that share an id are one item with the windows of both texts.
    Equal rows come back as often as they went in; rows that share an id but not a text are told apart by ``content``.
    """
    pairs = cut_lineage(item_windows(benchmark, item_id_col, item_text_col))
    size = F.least(F.size("window"), F.lit(SHINGLE))
    windows = pairs.select("window").distinct().select("window", size.alias("size"))
    shingles = F.when(F.col("size") == 1, shingles_of(F.col("window"), 1)).when(F.col("size") == 2, shingles_of(F.col("window"), 2)).otherwise(shingles_of(F.col("window"), 3))
    windows = cut_lineage(windows.select("window", F.size("window").alias("length"), shingles.alias("shingles"), "size"))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # 1 to SHINGLE
    wanted = windows.select(F.explode("shingles").alias("shingle")).distinct()
    wanted = small_side(wanted.unionByName(docs.sparkSession.createDataFrame([("",)], "shingle string")), max_rows=MAX_SENT)

    # one pass over the texts: the places of wanted shingles, and one row for each text at the place after its last
    # word; no word is empty, so that row's shingle is
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("content"), words_of(text_col).alias("w"))
    places = texts.select("_id", "content", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("place", "_word"))
    runs = [shingle_at(F.col("w"), F.col("place"), s) for s in sizes]
    last = F.col("place") == F.size("w")
    if len(runs) == 1:
        shingle = F.when(last, F.lit("")).otherwise(runs[0])
    else:
        shingle = F.explode(F.when(last, F.array(F.lit(""))).otherwise(F.array(*runs).cast("array<string>")))
    at = places.select("_id", "content", F.size("w").alias("n"), "place", shingle.alias("shingle"))
    seen = at.join(wanted, "shingle")
    # places once each, with the number of equal rows
    seen = written(seen.groupBy("_id", "content", "n", "place", "shingle").agg(F.count(F.lit(1)).alias("copies")), "shingle-places")
    found = seen.where("shingle <> ''").drop("copies")

    rarity = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    ranked = windows.select("window", "length", "shingles", F.posexplode("shingles").alias("offset", "shingle")).join(rarity, "shingle")
    # a window with a shingle that no text has cannot occur
    prefix = ranked.groupBy("window", "length", "shingles").agg(F.min(F.struct("seen", "shingle", "offset")).alias("rarest"), F.count(F.lit(1)).alias("known")).where(F.col("known") == F.size("shingles"))
    prefix = cut_lineage(prefix.select("window", "length", "shingles", F.col("rarest.shingle").alias("shingle"), F.col("rarest.offset").alias("offset")))
    start = F.col("place") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n"))
    candidates = found.join(prefix, "shingle").where(fits).select("_id", "content", start.alias("start"), "window", "length", "shingles")
    checked = candidates.select("_id", "content", "start", "window", "length", F.size("shingles").alias("all"), F.posexplode("shingles").alias("offset", "shingle"))
    checked = checked.withColumn("place", F.col("start") + F.col("offset"))
    there = found.select(F.col("_id").alias("_of"), F.col("content").alias("_content"), "place", "shingle")
    same_text = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("content") == F.col("_content"))
    met = checked.alias("c").join(there.alias("t"), same_text & (F.col("c.place") == F.col("t.place")) & (F.col("c.shingle") == F.col("t.shingle")))
    occurrences = met.groupBy("_id", "content", "start", "window", "length", "all").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.col("all"))
    occurrences = cut_lineage(occurrences.select("_id", "content", "start", "window", "length"))

    hit = occurrences.select("_id", "content", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("place")).distinct()
    n_hit = hit.groupBy("_id", "content").agg(F.count(F.lit(1)).alias("n_hit"))
    items = occurrences.select("_id", "content", "window").distinct().join(pairs, "window").select("_id", "content", F.col("item").cast("string").alias("item")).distinct()
    items = items.groupBy("_id", "content").agg(F.array_sort(F.collect_set("item")).alias("items"))
    result = n_hit.alias("h").join(items.alias("i"), F.col("h._id").eqNullSafe(F.col("i._id")) & (F.col("h.content") == F.col("i.content")))
    result = cut_lineage(result.select(F.col("h._id").alias("_of"), F.col("h.content").alias("_content"), "n_hit", "items"))
    rows = seen.where("shingle = ''").select("_id", "content", F.col("n").cast("long").alias("n_words"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    out = rows.join(result, same_text, "left")
    none = F.array().cast("array<string>")
    return out.select(F.col("_id").alias(id_col), "content", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
