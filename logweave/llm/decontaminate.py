"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

The index holds postings (term, document, position). A benchmark item is looked up by windows of
consecutive words: the lists of a window's rarest terms, each shifted by the term's offset, are
intersected on (window, document, start), and what is left is compared word by word with the
document. Terms are chosen by their counts over all documents; a window with a term that no
document holds is out at once. Only postings of chosen terms are stored, so the index grows with
the rare terms and not with all text; ``terms=None`` stores all.

Edge cases: null texts and texts without words hold nothing and are clean; items without words
have no window; items shorter than the width are one window; equal windows of several items count
for each item; rows equal in doc_id and text share their matches; a null doc_id is a document like
any other; null item_ids are listed as the empty string; texts of any length are searched whole;
empty tables on either side give no hits;
extra columns are ignored by :func:`contamination_report` and kept by :func:`keep_clean`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import ascii_lower, broadcast_if_small, row_key, stage

WIDTH = 13
#: Lists intersected per window: those of its rarest terms.
ANCHORS = 2
#: A document is contaminated if at least one of this many words is hit.
HIT_SHARE = 20


def terms_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A to Z in lower case."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.filter(parts, lambda w: w != "")


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``__key`` (key and text hash, never null), key and text."""
    return docs.select(row_key(key, text).alias("__key"), F.col(key).alias("__id"), F.col(text).alias("__text"))


def windows(benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Different windows (window, phrase, words), numbered, and which items hold them (phrase,
    item_id). Both are as small as the benchmark."""
    items = benchmark.select("item_id", terms_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    held = stage(
        items.select("item_id", "w", F.explode(starts).alias("s"))
        .select("item_id", F.slice("w", F.col("s"), F.least(F.size("w"), F.lit(width))).alias("words"))
        .select("item_id", "words", F.array_join("words", " ").alias("phrase"))
        .distinct(),
        "windows",
    )
    numbered = held.select("phrase", "words").distinct().withColumn("window", F.monotonically_increasing_id())
    return stage(numbered, "numbered-windows"), held.select("phrase", "item_id")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each term of ``vocabulary`` (staged) occurs in all documents."""
    exploded = docs.select(F.explode(terms_of(F.col("__text"))).alias("term"))
    return exploded.join(broadcast_if_small(vocabulary, F.octet_length("term")), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def anchors(numbered: DataFrame, counts: DataFrame, most: int = ANCHORS) -> DataFrame:
    """(window, term, offset, no, wanted) of the rarest terms of every window that can occur."""
    parts = numbered.select("window", F.size("words").alias("len"), F.posexplode("words").alias("offset", "term"))
    known = parts.groupBy("window", "term", "len").agg(F.min("offset").alias("offset"), F.count("*").alias("times")).join(counts, "term")
    of_window = Window.partitionBy("window")
    ranked = known.withColumn("found", F.sum("times").over(of_window)).where("found = len")
    ranked = ranked.withColumn("no", F.row_number().over(of_window.orderBy("n", "term")) - 1).where(F.col("no") < most)
    return ranked.withColumn("wanted", F.count("*").over(of_window)).select("window", "term", "offset", "no", "wanted")


def postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The index: (term, key, position) of the given terms (staged), or of all."""
    rows = docs.select("__key", F.posexplode(terms_of(F.col("__text"))).alias("position", "term"))
    if terms is not None:
        rows = rows.join(broadcast_if_small(terms, F.octet_length("term")), "term", "left_semi")
    return stage(rows.select("term", "__key", "position"), "postings")


def phrase_candidates(index: DataFrame, anchor: DataFrame) -> DataFrame:
    """(window, key, start) where all shifted lists of a window's anchors agree."""
    shifted = index.join(broadcast_if_small(anchor, F.octet_length("term")), "term")
    return (
        shifted.withColumn("start", F.col("position") - F.col("offset"))
        .where("start >= 0")
        .groupBy("window", "__key", "start", "wanted")
        .agg(F.bit_or(F.expr("shiftleft(1, no)")).alias("seen"))
        .where(F.col("seen") == F.expr("shiftleft(1, int(wanted)) - 1"))
        .select("window", "__key", "start")
    )


def proximity(index: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """(query_id, key, position) where all ``terms`` of a query occur, in any order, at most
    ``within`` words from an occurrence of its rarest term in ``index``. ``queries``: query_id, terms.
    Positions meet in cells of ``within`` words, so no two far ones are compared."""
    wanted = stage(queries.select("query_id", F.explode(F.array_distinct("terms")).alias("term")), "near-terms")
    counts = index.join(broadcast_if_small(wanted.select("term").distinct(), F.octet_length("term")), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    order = Window.partitionBy("query_id").orderBy("n", "term")
    ranked = wanted.join(counts, "term", "left").fillna(0, ["n"]).withColumn("no", F.row_number().over(order))
    sized = stage(ranked.withColumn("terms", F.count("*").over(Window.partitionBy("query_id"))), "near-ranks")
    found = index.join(broadcast_if_small(sized, F.octet_length("term")), "term").withColumn("cell", F.floor(F.col("position") / within))
    first = found.where("no = 1").select("query_id", "__key", "terms", F.col("position").alias("at"), F.explode(F.array(*[F.col("cell") + d for d in (-1, 0, 1)])).alias("cell"))
    return (
        first.join(found.select("query_id", "__key", "cell", "no", "position"), ["query_id", "__key", "cell"])
        .where(F.abs(F.col("at") - F.col("position")) <= within)
        .groupBy("query_id", "__key", "at", "terms")
        .agg(F.count_distinct("no").alias("near"))
        .where("near = terms")
        .select("query_id", "__key", F.col("at").alias("position"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``__key``, key, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = keyed(docs, key, text)
    distinct_windows, items = windows(benchmark, width)
    vocabulary = stage(distinct_windows.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    chosen = stage(anchors(distinct_windows, term_counts(rows, vocabulary)), "anchors")
    index = postings(rows, stage(chosen.select("term").distinct(), "anchor-terms"))
    phrases = broadcast_if_small(distinct_windows.select("window", "phrase"), F.octet_length("phrase"))
    candidates = phrase_candidates(index, chosen).join(phrases, "window").groupBy("__key").agg(F.collect_list(F.struct("start", "phrase")).alias("c"))

    # One pass over the texts counts all words and compares the candidates, whole phrase by phrase.
    w = F.col("w")
    lengths = lambda p: F.size(F.split(p, " "))
    same = lambda c: F.array_join(F.slice(w, c["start"] + 1, lengths(c["phrase"])), " ") == c["phrase"]
    checked = stage(
        rows.join(candidates, "__key", "left")
        .select("__key", "__id", terms_of(F.col("__text")).alias("w"), "c")
        .select("__key", "__id", F.size("w").cast("long").alias("n_words"), F.filter("c", same).alias("c")),
        "matches",
    )
    matches = checked.where(F.size("c") > 0).select("__key", F.explode("c").alias("c")).select("__key", "c.*").distinct()
    spans = matches.select("__key", "start", (F.col("start") + lengths(F.col("phrase"))).alias("end")).groupBy("__key", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("__key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new_words = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0))))
    hits = spans.withColumn("new", new_words).groupBy("__key").agg(F.sum("new").alias("n_hit"))
    names = matches.select("__key", "phrase").distinct().join(items, "phrase").select("__key", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    listed = names.groupBy("__key").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    return (
        checked.select("__key", F.col("__id").alias(key), "n_words")
        .join(hits.join(listed, "__key"), "__key", "left")
        .fillna({"n_hit": 0, "n_items": 0, "items": ""})
        .withColumn("items_sha256", F.sha2("items", 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words")))
        .select("__key", key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    return contamination(docs, benchmark, width, key, text).drop("__key")


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = contamination(docs, benchmark, width, key, text).where("contaminated").select("__key").distinct()
    return docs.withColumn("__key", row_key(key, text)).join(stage(bad, "contaminated"), "__key", "left_anti").select(*docs.columns)
