"""Benchmark passages in training text, through a positional inverted index.

The index is a table of postings (term, document, position). Only lists that a
test needs are made: first the terms' frequencies, then the postings of each
window's rarest terms. Shifted by the term's place in its window, the lists are
intersected by grouping; what is left is compared word by word with the text.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import stage

WIDTH = 10
# Lists intersected before the exact comparison.
RAREST = 2
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([0-9A-Za-z\x{80}-\x{10FFFF}]+)"), F.lit(1))


def lowered(word: Column) -> Column:
    """A-Z only; the short form is the common case of a word without others."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, _UPPER, _UPPER.lower())
    )


def test_windows(items: DataFrame, width: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: ``win``, ``words`` and the ids of the items they stand in."""
    low = F.transform(words_of(F.coalesce(F.col(f"`{text}`"), F.lit(""))), lowered)
    listed = items.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("null")).alias("item"), low.alias("all")
    ).filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (width - 1), F.lit(1)))
    return (
        listed.select("item", "all", F.explode(starts).alias("at"))
        .select("item", F.slice("all", F.col("at"), F.lit(width)).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
        .select(F.sha2(F.array_join("words", " "), 256).alias("win"), "words", "items")
    )


def postings(docs: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """(term, ``_key``, ``_hash``, position) of the wanted terms."""
    body = F.col(f"`{text}`")
    return (
        docs.select(
            F.col(f"`{key}`").alias("_key"), F.xxhash64(body).alias("_hash"),
            F.posexplode(words_of(body)).alias("pos", "word"),
        )
        .select("_key", "_hash", "pos", lowered(F.col("word")).alias("term"))
        .join(terms, "term")
    )


def rarest_terms(docs: DataFrame, windows: DataFrame, rarest: int, key: str, text: str) -> DataFrame:
    """(term, win, shift, need): each window's rarest words and their places."""
    spread = windows.select("win", F.posexplode("words").alias("shift", "term"))
    # Written, so that Spark plans by its true size: broadcast if small.
    terms = stage(spread.select("term").distinct(), "test-terms")
    often = postings(docs, terms, key, text).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("win").orderBy("n", "term", "shift")
    # A window with a word that no text holds cannot occur.
    found = (
        spread.join(often, "term", "left")
        .withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("win")))
        .filter("least > 0")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= rarest)
    )
    need = F.count(F.lit(1)).over(Window.partitionBy("win"))
    return stage(found.select("term", "win", "shift", need.alias("need")), "rarest-terms")


def phrase_candidates(docs: DataFrame, lists: DataFrame, key: str, text: str) -> DataFrame:
    """Starts at which all of a window's rarest words stand where they should."""
    # A word may be wanted by many windows: look-ups by term, then the windows.
    terms = stage(lists.select("term").distinct(), "wanted-terms")
    return (
        postings(docs, terms, key, text)
        .join(lists, "term")
        .select("_key", "_hash", "win", (F.col("pos") - F.col("shift")).alias("start"), "need")
        .filter("start >= 0")
        .groupBy("_key", "_hash", "win", "start", "need")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n >= need")
        .select("_key", "_hash", "win", "start")
    )


def contaminated_words(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    carry: tuple[str, ...] = (),
    rarest: int = RAREST,
) -> DataFrame:
    """One row per row of ``docs``: key, ``n_words``, ``n_hit`` (words inside a
    window's occurrence), ``n_items``, ``item_list``, ``contaminated``, ``spans``
    (start, length of each occurrence) and the ``carry`` columns.

    NULL texts have no words. Rows alike in key and text get the same result,
    each its own. A NULL item id is the item "null". Empty tables give no hits
    or no rows.
    """
    windows = stage(test_windows(items, width, item, text), "test-windows")
    lists = rarest_terms(docs, windows, rarest, key, text)
    found = phrase_candidates(docs, lists, key, text)
    at = F.struct(F.col("start"), F.col("words"), F.col("items")).alias("c")
    by_doc = (
        found.join(windows, "win")
        .groupBy("_key", "_hash")
        .agg(F.collect_list(at).alias("cands"))
    )
    carried = [c for c in carry if c != key]
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{key}`").alias("_own"), F.xxhash64(body).alias("_h"), body.alias("_text"),
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried) if c != text],
    )
    same = F.col("_own").eqNullSafe(F.col("_key")) & (F.col("_h") == F.col("_hash"))
    # The text is shuffled once, also where it is asked for.
    carried_cols = [F.col("_text" if c == text else f"_c{i}").alias(f"_c{i}") for i, c in enumerate(carried)]
    told = rows.join(by_doc, same, "left").select(
        "_own", *carried_cols, "cands", words_of(F.coalesce("_text", F.lit(""))).alias("_words"),
    )
    # Lower-casing all words is needed where something may be found only.
    low = F.when(F.col("cands").isNotNull(), F.transform("_words", lowered))
    told = told.withColumn("_n", F.size("_words").cast("long")).withColumn("_words", low)
    exact = F.filter(
        F.coalesce("cands", F.array().cast(by_doc.schema["cands"].dataType)),
        lambda c: F.slice(F.col("_words"), c["start"] + 1, F.size(c["words"])) == c["words"],
    )
    told = told.select("_own", *[f"_c{i}" for i in range(len(carried))], "_n", exact.alias("hits"))
    spans = F.array_sort(
        F.transform("hits", lambda c: F.struct(
            c["start"].cast("long").alias("start"), F.size(c["words"]).cast("long").alias("length")))
    )
    told = told.withColumn("spans", spans).withColumn(
        "item_list", F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda c: c["items"]))))
    )
    zero = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n"))

    def cover(a: Column, s: Column) -> Column:
        end = s["start"] + s["length"]
        more = F.greatest(end - F.greatest(a["to"], s["start"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(a["to"], end).alias("to"), (a["n"] + more).alias("n"))

    hit = F.aggregate("spans", zero, cover, lambda a: a["n"])
    return told.select(
        F.col("_own").alias(key), F.col("_n").alias("n_words"), hit.alias("n_hit"),
        F.size("item_list").cast("long").alias("n_items"), "item_list",
        (F.size("spans") > 0).alias("contaminated"), "spans",
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)],
    )


def proximity_matches(
    docs: DataFrame, items: DataFrame, slop: int = 4, width: int = WIDTH,
    key: str = "doc_id", text: str = "text", item: str = "item_id",
) -> DataFrame:
    """(key, item, ``start``): windows whose two rarest words stand within
    ``slop`` words of their distance in the window; exact matches are included.
    Lists are joined on cells of ``slop + 1`` starts and the next cell."""
    windows = stage(test_windows(items, width, item, text), "test-windows")
    lists = rarest_terms(docs, windows, 2, key, text)
    order = F.row_number().over(Window.partitionBy("win").orderBy("shift"))
    terms = stage(lists.select("term").distinct(), "wanted-terms")
    at = (
        postings(docs, terms, key, text)
        .join(lists.withColumn("side", order), "term")
        .withColumn("start", F.col("pos") - F.col("shift"))
        .withColumn("cell", F.floor(F.col("start") / (slop + 1)))
    )
    one = at.filter("side = 1").select("_key", "_hash", "win", "need", "start", "cell")
    two = at.filter("side = 2").select(
        "_key", "_hash", "win", F.col("start").alias("other"),
        F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"),
    )
    on = ["win", "cell", "_hash"]
    left, right = one.alias("l"), two.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on] + [F.col("l._key").eqNullSafe(F.col("r._key"))]
    pairs = left.join(right, same).filter(F.abs(F.col("start") - F.col("other")) <= slop)
    found = pairs.select("l._key", "l.win", "start").unionByName(
        one.filter("need = 1").select("_key", "win", "start")
    )
    return (
        found.join(windows.select("win", F.explode("items").alias(item)), "win")
        .select(F.col("_key").alias(key), item, "start").distinct()
    )
