"""Benchmark decontamination: words of documents inside windows of benchmark items, as a set join.

A window is a short run of an item's words; it occurs in a document if all of its shingles (runs of a few
words) stand there in place. One pass over the documents notes where the benchmark's shingles stand. Of a
window, the shingle that is rarest in the documents is enough to find all its occurrences: only that one is
joined, and each candidate is kept if every other shingle of the window stands at its place beside it. All of it
is DataFrame operations.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.tables import fresh, stored

# Rows of the benchmark's tables that are broadcast at most; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
# What separates words, by default: ASCII but for digits and letters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(word: Column) -> Column:
    """A-Z in lower case, and nothing else. The built-in function does that where all is ASCII."""
    slow = F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(slow)


def words_of(text: Column) -> Column:
    """Words of a text, in lower case; none for null."""
    found = F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))
    return F.transform(found, ascii_lower)


def part(words: Column, start: Column, size: Column) -> Column:
    """``size`` words from ``start`` (0 is the first) on, as one string. Words hold no spaces, so it tells them apart."""
    return F.array_join(F.slice(words, start + 1, size), " ")


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast if its ``rows`` are few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``item, content, n_words`` of each distinct window: ``window`` words, or all words of a shorter item."""
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
    size = F.least(F.size("words"), F.lit(window))
    starts = F.when(size > 0, F.sequence(F.lit(0), F.size("words") - size))
    placed = words.withColumn("n_words", size).withColumn("start", F.explode(starts))
    return placed.select("item", "n_words", part(F.col("words"), F.col("start"), F.col("n_words")).alias("content")).distinct()


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``content, n_words, offset, shingle, size`` of the shingles of each window; a shorter window is one."""
    split = windows.withColumns({"words": F.split("content", " "), "size": F.least("n_words", F.lit(shingle))})
    placed = split.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("n_words") - F.col("size"))))
    return placed.withColumn("shingle", part(F.col("words"), F.col("offset"), F.col("size"))).drop("words")


def word_key(words: Column, pos: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, pos + k) for k in range(size)])


def standing(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """``doc, pos, id, n_words``: where the ``shingles(id, shingle, size)`` stand in ``docs(doc, words)``.

    Each document has a row with its ``n_words`` too, and no ``pos`` and ``id``.
    """
    kind = "doc", "pos", "id", "n_words"
    nothing = F.lit(None).cast("long")
    n_words = F.size("words").cast("long")
    out = None
    for row in shingles.groupBy("size").count().orderBy("size").collect():  # a row for each size up to the shingle's
        size = row["size"]
        words = F.split("shingle", " ")
        some = shingles.filter(F.col("size") == size).select("id", "shingle", word_key(words, F.lit(0), size).alias("key"))
        last = F.size("words") - size
        if out is None:  # the first size brings the documents' own rows, as place -1
            placed = docs.withColumn("pos", F.explode(F.sequence(F.lit(-1), F.greatest(last, F.lit(-1)))))
            key = F.when(F.col("pos") >= 0, word_key(F.col("words"), F.col("pos"), size))
            how = "left"
        else:
            placed = docs.withColumn("pos", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))))
            key, how = word_key(F.col("words"), F.col("pos"), size), "inner"
        met = placed.withColumn("key", key).join(small(some, row["count"]), "key", how)
        same = F.when(F.col("id").isNotNull(), part(F.col("words"), F.col("pos"), F.lit(size)) == F.col("shingle"))
        own = F.col("pos") < 0
        found = met.filter(same | own).select(
            "doc", F.when(~own, F.col("pos")).alias("pos"), "id", F.when(own, n_words).alias("n_words")
        )
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.select("doc", nothing.cast("int").alias("pos"), nothing.alias("id"), n_words.alias("n_words"))
    return out.select(*kind)


def occurrences(stands: DataFrame, placed: DataFrame) -> DataFrame:
    """``doc, start, end, content`` of each place where all shingles of a window of
    ``placed(content, n_words, offset, id)`` are among ``stands(doc, pos, id)``.
    """
    counts = stands.groupBy("id").agg(F.count(F.lit(1)).alias("count"))
    first = F.min(F.struct(F.coalesce("count", F.lit(0).cast("long")).alias("count"), "id", "offset")).alias("rarest")
    windows = placed.join(counts, "id", "left").groupBy("content", "n_words").agg(first, F.count(F.lit(1)).alias("shingles"))
    # A window with a shingle that never occurs cannot occur.
    windows = windows.filter(F.col("rarest.count") > 0).select("content", "n_words", "shingles", F.col("rarest.id").alias("id"), "rarest.offset")
    windows = stored(windows, "rarest")
    begun = stands.join(small(windows, windows.count()), "id").withColumn("start", F.col("pos") - F.col("offset")).filter("start >= 0")
    begun = begun.select("doc", "start", "content", "n_words", "shingles")
    wanted = begun.join(small(placed.select("content", "offset", "id"), placed.count()), "content")
    wanted = wanted.withColumn("pos", F.col("start") + F.col("offset"))
    held = wanted.join(stands, ["doc", "pos", "id"]).groupBy("doc", "start", "content").agg(
        F.first("n_words").alias("n_words"), F.first("shingles").alias("shingles"), F.count(F.lit(1)).alias("held")
    )
    whole = held.filter("held = shingles")
    return whole.select("doc", "start", (F.col("start") + F.col("n_words")).alias("end"), "content")


def covered(spans: Column) -> Column:
    """How many words sorted or unsorted spans cover together."""
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))

    def add(state: Column, span: Column) -> Column:
        begin = F.greatest(state["to"], span["start"])
        more = F.greatest(span["end"] - begin, F.lit(0))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["to"], span["end"]).alias("to"))

    return F.aggregate(F.array_sort(spans), nothing, add, lambda s: s["n"])


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Every column of ``docs`` but the text, and what each text shares with the benchmark.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII; A-Z count as a-z.
    A window is ``window`` consecutive words of an item, or all words of a shorter one. Added (and replaced, if
    they exist): ``n_words``; ``n_hit``, how many words lie inside an occurrence of a window; ``hits``,
    the occurrences as ``start, end`` in words, in order; ``items``, the ids (as strings, sorted) of items
    with an occurring window; ``contaminated``, whether there is any.

    Null and empty texts have no words, and items without words have no windows. An item without an id
    marks words, but cannot be listed in ``items``; equal ids are one item. Rows are neither merged nor dropped;
    rows that repeat both id and text share one result, and null ids are ids like others. Empty tables on
    either side are fine. The benchmark's tables are broadcast up to ``BROADCAST_ROWS``, else shuffled.
    """
    added = ("n_words", "n_hit", "hits", "items", "contaminated")
    rest = docs.drop(*added).drop(text_col)
    key = fresh(docs.drop(*added), "key")[0]
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = F.struct(F.col(id_col).alias("id"), F.xxhash64(whole).alias("version"))  # a struct's nulls are equal
    keyed = docs.select(same.alias("doc"), words_of(F.col(text_col)).alias("words"))
    listed = stored(item_windows(items, window, item_col, item_text_col), "item-windows")
    spread = window_shingles(listed.select("content", "n_words").distinct(), shingle)
    shingles = spread.select("shingle", "size").distinct().withColumn("id", F.monotonically_increasing_id())
    shingles = stored(shingles, "benchmark-shingles")
    placed = stored(spread.join(shingles, ["shingle", "size"]).select("content", "n_words", "offset", "id"), "window-shingles")
    noted = stored(standing(keyed, shingles), "shingle-places")
    # Rows that repeat id and text have noted the same places.
    hits = stored(occurrences(noted.filter("id IS NOT NULL").select("doc", "pos", "id").distinct(), placed), "hits")
    spans = hits.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("hits"))
    in_items = hits.select("doc", "content").distinct().join(small(listed, listed.count()), "content")
    named = in_items.groupBy("doc").agg(F.array_sort(F.collect_set("item")).alias("items"))
    sizes = noted.filter("id IS NULL").groupBy("doc").agg(F.max("n_words").alias("n_words"))
    found = sizes.join(spans, "doc", "left").join(named, "doc", "left")
    found = found.select(F.col("doc").alias(key), F.struct("n_words", "hits", "items").alias("found"))
    every = docs.select(F.struct(*rest.columns).alias("row"), same.alias(key))
    return every.join(found, key, "left").select(
        "row.*",
        F.col("found.n_words").alias("n_words"),
        F.coalesce(covered(F.col("found.hits")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("found.hits", F.array().cast("array<struct<start:int,end:int>>")).alias("hits"),
        F.coalesce("found.items", F.array().cast("array<string>")).alias("items"),
        F.col("found.hits").isNotNull().alias("contaminated"),
    )


def drop_leaked(docs: DataFrame, items: DataFrame, most: float = 0.0, **options) -> DataFrame:
    """``docs`` without the documents of whose words more than the share ``most`` lies in benchmark windows.

    Keeps the columns of ``docs``, and its rows as they are (see :func:`with_leaks` for odd ones); a null or
    empty text stays.
    """
    packed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(options.pop("id_col", "doc_id")).alias("id"),
        F.col(options.pop("text_col", "text")).alias("text"),
    )
    judged = with_leaks(packed, items, id_col="id", **options)
    return judged.filter(F.col("n_hit") <= most * F.col("n_words")).select("row.*")
