"""Benchmark decontamination over a distributed positional inverted index.

The index is a stored table of postings (document, position, term): one row per
occurrence of a benchmark term in the corpus, written once and split by ranges
of documents, so no term's list ever has to fit in one task. A last posting per
document holds its word count.

A phrase is found by intersecting offset-adjusted lists. Every window of the
benchmark takes its rarest term (by the counts in the index) as anchor; the
anchor's postings, moved back by its offset, are the candidate starts. The
second rarest term prunes these, and the rest of the window's terms are then
intersected at their offsets; a start where all terms meet is an occurrence.

Near matches need no order: an item is near where its rarest terms all occur
within its own length of one of them (``proximity``).

All joins on documents use the document's own row number, so the largest key is
one document. Tables that grow with the benchmark are broadcast, in parts if they
are large (``join_parts``), so a term or a passage that many documents share is
met where its postings are.

Defined results. Null, empty or separator-only text: no words, never
contaminated. An item without words has no windows. Repeated rows, also under
one id, are judged each. Items under one id count as one in ``n_items`` and ``n_near``, each
with its own text; the id of an item without one is the empty text. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import MAX_BROADCAST_ROWS, ascii_lower, filter_rows, join_parts, materialise, numbered

WINDOW = 13
#: Separators after lower-casing; equals [\x00-\x2F\x3A-\x60\x7B-\x7F]+ there.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rarest terms of an item that make a near match.
NEAR_TERMS = 4
#: A word that no text can contain: marks the end of a document.
END = "\x00end"


def words(text):
    """The words of a text Column; null has none."""
    split = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATOR)
    return F.array_remove(split, "")


def windows(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (win, terms) and their owners (win, item_id)."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    rows = w.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("terms"))
    rows = materialise(rows.withColumn("win", F.array_join("terms", " ")), "windows")
    owners = rows.select("win", "item_id")
    return rows.select("win", "terms").distinct(), owners


def vocabulary(wins: DataFrame) -> DataFrame:
    """(term, word): a number for every distinct word of ``wins`` (terms)."""
    ids = wins.select(F.explode("terms").alias("word")).distinct()
    return materialise(ids.select(F.monotonically_increasing_id().alias("term"), "word"), "vocabulary")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (rid, doc_id, pos, term) of ``terms`` (term, word), plus term -1
    at position n_words for every row of ``docs``."""
    end = terms.sparkSession.range(1).select(F.lit(-1).cast("long").alias("term"), F.lit(END).alias("word"))
    ended = materialise(terms.select("term", "word").unionByName(end), "terms")
    # Rows are numbered before they are exploded into tokens.
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    if ended.count() > MAX_BROADCAST_ROWS:  # read once per part of the terms
        rows = materialise(rows, "numbered-documents")
    tokens = rows.select(
        "rid", "doc_id", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "word")
    )
    return materialise(join_parts(tokens, ended, ["word"]).select("rid", "doc_id", "pos", "term"), "postings")


def frequencies(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, word, cf): how often each term occurs; 0 for one without postings."""
    counts = index.where("term >= 0").groupBy("term").agg(F.count("*").alias("cf"))
    return materialise(terms.join(counts, "term", "left").select("term", "word", F.coalesce("cf", F.lit(0)).alias("cf")), "frequencies")


def occurrences(index: DataFrame, wins: DataFrame, freq: DataFrame) -> DataFrame:
    """(rid, win_id, start, len): every exact occurrence of every window."""
    parts = wins.select("win_id", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "word")).join(freq, "word")
    rank = F.row_number().over(Window.partitionBy("win_id").orderBy("cf", "off"))
    # A window with a term that occurs nowhere occurs nowhere.
    dead = F.min("cf").over(Window.partitionBy("win_id")) == 0
    parts = materialise(parts.withColumns({"k": rank, "dead": dead}).where("not dead").drop("dead", "word"), "plan")
    leading = materialise(parts.where("k <= 2").select("term").distinct(), "leading-terms")
    lists = materialise(join_parts(index.select("rid", "pos", "term"), leading, ["term"], "left_semi"), "leading-lists")
    anchors = materialise(parts.where("k = 1").select("win_id", "len", "term", F.col("off").alias("off1")), "anchors")
    found = join_parts(lists, anchors, ["term"]).select("rid", "win_id", "len", (F.col("pos") - F.col("off1")).alias("start"))
    found = materialise(found, "candidates")
    # The second rarest term: few postings, so the bulk of false starts ends here.
    second = materialise(parts.where("k = 2").select("win_id", "term", "off"), "second-terms")
    key = ["rid", "pos", "term"]
    ask = join_parts(found.where("len > 1"), second, ["win_id"]).withColumn("pos", F.col("start") + F.col("off"))
    met = ask.join(lists, key, "left_semi").select("rid", "win_id", "len", "start")
    starts = materialise(met.unionByName(found.where("len = 1").select(*met.columns)), "starts")
    # The rest of each window's terms, at their offsets.
    rest = materialise(parts.where("k > 2").select("win_id", "term", "off"), "rest-terms")
    need = join_parts(starts, rest, ["win_id"]).select(
        "rid", (F.col("start") + F.col("off")).alias("pos"), "term", "win_id", "len", "start"
    )
    docs = materialise(starts.select("rid").distinct(), "candidate-documents")
    docs = F.broadcast(docs) if docs.count() <= MAX_BROADCAST_ROWS else docs
    own = index.select(*key).where("term >= 0").join(docs, "rid", "left_semi")
    full = (
        need.join(own, key, "left_semi")
        .groupBy("rid", "win_id", "len", "start")
        .agg(F.count("*").alias("n"))
        .where("n = len - 2")
        .drop("n")
    )
    short = starts.where("len <= 2")
    return full.unionByName(short.select(*full.columns))


def contamination(docs: DataFrame, items: DataFrame, share: int = 20, near: bool = True) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row, and
    with ``near`` also n_near, the items that have a near match in the row.

    A document is contaminated if ``n_hit > 0 and share * n_hit >= n_words``.
    """
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    wins, owners = windows(items)
    wins = materialise(wins.withColumn("win_id", F.monotonically_increasing_id()), "distinct-windows")
    terms = vocabulary(wins)
    index = build_index(docs, terms)
    freq = frequencies(index, terms)
    hits = materialise(occurrences(index, wins, freq), "occurrences")
    # Words inside any occurrence: the union of intervals, in order of their starts.
    end = F.col("start") + F.col("len")
    w = Window.partitionBy("rid").orderBy("start", "len")
    reach = F.coalesce(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = hits.select("rid", "start", "len").distinct()
    fresh = spans.select("rid", F.greatest(F.lit(0), end - F.greatest("start", reach)).alias("fresh"))
    hit = fresh.groupBy("rid").agg(F.sum("fresh").alias("n_hit"))
    owner = owners.join(wins.select("win_id", "win"), "win").select("win_id", F.col("item_id").alias("i"))
    owner = materialise(owner.distinct(), "owners")
    items_of = (
        join_parts(hits.select("rid", "win_id").distinct(), owner, ["win_id"])
        .select("rid", "i")
        .distinct()
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list("i")).alias("items"))
    )
    found = hit.join(items_of, "rid")
    if near:
        met = proximity(index, rare_terms(items, freq), freq).select("rid", "query_id").distinct()
        found = found.join(met.groupBy("rid").agg(F.count("*").alias("n_near")), "rid", "full")
    found = materialise(found, "hits")
    ends = index.where("term = -1").select("rid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    out = [
        F.col("doc_id"),
        F.col("n_words"),
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    ]
    if near:
        out.append(F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    return ends.join(found, "rid", "left").select(*out)


def rare_terms(items: DataFrame, freq: DataFrame, most: int = NEAR_TERMS) -> DataFrame:
    """(query_id, terms, reach): the rarest distinct terms of each item, by corpus
    count and then by word, and the item's number of words."""
    rows = items.select("item_id", F.monotonically_increasing_id().alias("q"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    rows = materialise(rows, "item-words")
    each = rows.select("q", F.explode(F.array_distinct("w")).alias("word")).join(freq, "word")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("cf", "word"))
    few = each.withColumn("k", rank).where(F.col("k") <= most).groupBy("q").agg(F.collect_list("word").alias("terms"))
    return rows.select("q", F.col("item_id").alias("query_id"), F.size("w").alias("reach")).join(few, "q").drop("q")


def proximity(index: DataFrame, queries: DataFrame, freq: DataFrame) -> DataFrame:
    """(rid, query_id, start, stop): places where all terms of a query (query_id,
    terms array, reach) occur less than ``reach`` positions from one of the rarest.

    Order is free. A query with a term that occurs nowhere has no place. Positions
    are met in blocks as wide as the reach, so the join is an equality on
    (document, block, term), never a pairing of all postings.
    """
    rows = queries.withColumn("q", F.monotonically_increasing_id()).withColumn("terms", F.array_distinct("terms"))
    rows = materialise(rows, "queries")
    width = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("reach").cast("double")))).cast("long")  # few widths, so few lists
    each = rows.select("q", "reach", width.alias("width"), F.size("terms").alias("k"), F.explode("terms").alias("word"))
    each = materialise(each.join(freq, "word"), "query-terms")
    rarest = each.groupBy("q", "k", "reach", "width").agg(F.min_by("term", F.struct("cf", "word")).alias("term"))
    rarest = materialise(rarest, "rarest-terms")
    wanted = materialise(each.select("term", "width").distinct(), "wanted-lists")
    lists = join_parts(index.select("rid", "pos", "term"), wanted, ["term"])
    lists = materialise(lists.withColumn("block", F.floor(F.col("pos") / F.col("width"))), "near-lists")
    at = join_parts(lists, rarest, ["term", "width"]).select("rid", "q", "k", "reach", "width", "block", F.col("pos").alias("at"))
    others = materialise(each.select("q", "term"), "other-terms")
    b = F.col("block")
    ask = join_parts(at, others, ["q"]).withColumn("block", F.explode(F.array(b - 1, b, b + 1)))
    met = ask.join(lists, ["rid", "term", "width", "block"]).where(F.abs(F.col("pos") - F.col("at")) < F.col("reach"))
    near = met.groupBy("rid", "q", "k", "at", "term").agg(
        F.min_by("pos", F.struct(F.abs(F.col("pos") - F.col("at")), "pos")).alias("pos")
    )
    full = near.groupBy("rid", "q", "k", "at").agg(F.count("*").alias("n"), F.min("pos").alias("start"), F.max("pos").alias("stop"))
    names = materialise(rows.select("q", "query_id"), "query-names")
    return join_parts(full.where("n = k"), names, ["q"]).select("rid", "query_id", "start", "stop").distinct()


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; every row is judged on its own."""
    rows, number = numbered(docs, "contamination-rows")
    found = contamination(rows.select(F.col(number).alias("doc_id"), "text"), items, near=False)
    return filter_rows(rows, number, found.where("contaminated").select(F.col("doc_id").alias(number)), keep=False)
