"""Benchmark decontamination: a prefix-filtered set join between item windows and documents.

A window is a run of consecutive item words (the whole item where it has fewer). Its set of
shingles is contained in a document exactly where all of them stand at consecutive places, so
the window's rarest shingle is the prefix that must match: only its places are candidates.
Candidates pass a length bound (the window must fit before the document's end) and a positional
bound (it cannot start before the document), and are verified by counting all shingles of the
window at their places.

Only DataFrame functions are used. The documents are read twice and never shuffled: what moves
are places whose shingle occurs in the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge.llm.tables import ascii_lower, stored

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: Rows of the shingle list that may be broadcast (16 bytes each); a longer list is shuffled.
BROADCAST_SHINGLES = 500_000
#: Words before A to Z are lower-cased, which changes no boundary.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
KEY = "__row"
HEADER = -1  # place of the row that each document has besides its hits


def words_of(text: Column) -> Column:
    """Words of a text as they stand; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _lowered(word: Column) -> Column:
    """A to Z lower-cased; ``lower`` is much the faster where it does the same."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(ascii_lower(word))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Equal for equal rows only, so repeated ids with other texts stay apart."""
    return F.xxhash64(F.col(id_column).cast("string"), F.lit("|"), F.col(text_column))


def _shingles(words: Column, size: int) -> Column:
    """Hashes of ``size`` consecutive words by place; none where the text is shorter."""

    def of(hashed: Column) -> Column:
        places = F.when(F.size(hashed) >= size, F.sequence(F.lit(0), F.size(hashed) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(*[F.get(hashed, i + j) for j in range(size)]))

    # bound as a lambda variable, the word hashes are made once and not once for each place
    return F.get(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(_lowered(w)))), of), 0)


def item_windows(items: DataFrame, window_words: int) -> DataFrame:
    """(item_id, w): every window of every item as an array of words."""
    words = F.transform(words_of(F.col("text")), _lowered)
    worded = items.select(F.col("item_id").cast("string").alias("item_id"), words.alias("ws"))
    last = F.greatest(F.size("ws") - window_words, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last))
    return (
        worded.filter(F.size("ws") > 0)
        .select("item_id", "ws", starts.alias("s"))
        .select("item_id", F.slice("ws", F.col("s") + 1, F.lit(window_words)).alias("w"))
        .distinct()
    )


def contamination(
    documents: DataFrame,
    items: DataFrame,
    window_words: int = WINDOW_WORDS,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """Words of each document that lie in an occurrence of an item window, one row per document.

    Columns: doc_id, n_words, n_hit, n_items, items (ids as strings, sorted), contaminated.
    A NULL or empty text has no words and is clean; repeated rows each get a row; a NULL
    ``doc_id`` is kept; items with equal texts are all named; items without words match nothing;
    with an empty item table every document is clean.
    """
    return _contamination(documents, items, window_words, shingle_words).drop(KEY)


def without_contaminated(documents: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``documents`` that hold no item window, with their columns as they came."""
    found = _contamination(documents, items, window_words, SHINGLE_WORDS).filter("contaminated")
    hit = stored(found.select(F.col(KEY).alias("__hit")).distinct(), "contaminated")
    return documents.join(hit, row_key() == F.col("__hit"), "left_anti")


def _contamination(documents: DataFrame, items: DataFrame, window_words: int, shingle_words: int) -> DataFrame:
    windows = stored(
        item_windows(items, window_words).select(
            "item_id", F.xxhash64("w").alias("wid"), "w", F.size("w").alias("m")
        ),
        "windows",
    )
    distinct = windows.dropDuplicates(["wid"]).withColumn("k", F.least("m", F.lit(shingle_words)))
    sizes = sorted(r["k"] for r in distinct.select("k").distinct().collect())  # at most shingle_words values
    pieces = None
    for k in sizes:
        part = distinct.filter(F.col("k") == k).select("wid", "m", "k", F.posexplode(_shingles(F.col("w"), k)).alias("off", "h"))
        pieces = part if pieces is None else pieces.unionByName(part)
    rows = documents.select("doc_id", row_key().alias(KEY), words_of(F.col("text")).alias("ws"))
    if pieces is None:
        return rows.select("doc_id", KEY, F.size("ws").alias("n_words")).select(
            "doc_id", KEY, F.col("n_words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
            F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"),
        )
    pieces = stored(pieces, "pieces")
    placed = stored(_places(rows, pieces, sizes), "places")
    counted = placed.filter(F.col("p") == HEADER).select("doc_id", KEY, F.col("n").alias("n_words"))
    hits = placed.filter(F.col("p") > HEADER)
    found = stored(_occurrences(hits, pieces), "found")
    covered = (
        found.select(KEY, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("m") - 1)).alias("p"))
        .distinct()
        .groupBy(KEY)
        .agg(F.count("*").alias("n_hit"))
    )
    named = (
        found.select(KEY, "wid")
        .distinct()
        .join(windows.select("wid", "item_id"), "wid")
        .groupBy(KEY)
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return counted.join(covered.join(named, KEY), KEY, "left").select(
        "doc_id",
        KEY,
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def _places(rows: DataFrame, pieces: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, row, n, p, h): places of documents whose shingle occurs in a window.

    Each document also has a header row at place ``HEADER``, which carries its number of words.
    """
    known = pieces.select("h").distinct().withColumn("known", F.lit(True))
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)

    def placed(ws: Column) -> Column:
        by_size = [F.transform(_shingles(ws, k), lambda h, i: F.struct(i.alias("p"), h.alias("h"))) for k in sizes]
        header = F.array(F.struct(F.lit(HEADER).alias("p"), F.col(KEY).alias("h")))
        return F.struct(F.size(ws).alias("n"), F.concat(header, *by_size).alias("at"))

    # a generator for each step, so that no projection is merged into another and computed again
    worded = rows.select("doc_id", KEY, F.inline(F.transform(F.array("ws"), placed)))
    marked = worded.select("doc_id", KEY, "n", F.inline("at")).join(known, "h", "left")
    return marked.filter(F.col("known") | (F.col("p") == HEADER)).drop("known")


def _occurrences(hits: DataFrame, pieces: DataFrame) -> DataFrame:
    """(row, start, m, wid): verified occurrences of windows."""
    rarity = hits.groupBy("h").agg(F.count("*").alias("uses"))
    ordered = pieces.join(rarity, "h", "left").groupBy("wid", "m", "k").agg(
        F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "h", "off")).alias("rarest")
    )
    prefix = ordered.filter(F.col("rarest.uses") > 0).select("wid", "m", "k", "rarest.h", "rarest.off")
    candidates = (
        hits.join(prefix, "h")
        .withColumn("start", F.col("p") - F.col("off"))
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("m") <= F.col("n")))
        .select(KEY, "start", "m", "k", "wid")
    )
    wanted = candidates.join(pieces.select("wid", "off", "h"), "wid").withColumn("p", F.col("start") + F.col("off"))
    return (
        wanted.join(hits.select(KEY, "p", "h"), [KEY, "p", "h"])
        .groupBy(KEY, "start", "m", "k", "wid")
        .agg(F.count_distinct("off").alias("matched"))
        .filter(F.col("matched") == F.col("m") - F.col("k") + 1)
        .select(KEY, "start", "m", "wid")
    )
