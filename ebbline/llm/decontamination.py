"""Benchmark decontamination with a distributed positional inverted index. DataFrame operations only.

Words of documents and benchmark items: A-Z lower-cased, then maximal runs of 0-9, a-z and characters beyond ASCII. The index
is a table of postings (document, term, position), stored once in the shared folder; terms that no test item has can
match nothing and get no posting. A header posting of every document holds its word count.

An occurrence of an item at a document lies on a diagonal: document position minus item position is the same for all
its words. So the posting list of a term, its positions less the term's offset in the item, is a list of diagonals, and a phrase
occurs where the lists of its terms intersect. Lists are taken from the rarest terms first: for every window of an
item the SEEDS positions with the rarest terms (by training document postings) are seeds; a diagonal on which fewer seeds
meet than any window has cannot hold a window. The diagonals that are left are checked on the texts of their documents, which
is less to shuffle than the lists of frequent terms: the positions that match are counted in runs, and a run of ``window`` words (or the whole of a shorter item) is an exact match. For
proximity, the seeds of an item that meet within ``slop`` positions of one diagonal are counted: an item whose words stand in their order,
with up to ``slop`` words put in or left out, though no ten of them in a row.

Null and empty texts have no words: n_words 0, never hit; an item without words matches nothing. Repeated document rows
give repeated result rows; of repeated items each id counts once. Documents are told apart by id and a hash of the
text, so equal ids with different texts stay apart. Null ids are kept; a null item id is left out of the digest. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbline.llm.common import without_rows
from ebbline.session import stage

WINDOW = 10
SEEDS = 3
SLOP = 5
#: Seeds that must be near each other for a proximity match.
NEAR_SEEDS = 4
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEADER = ""
DOC = ("doc_id", "text_hash")


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    parts = F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.array_remove(parts, "")


def item_texts(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (a hash of id and text), item_id, w (the words) and item_words of every distinct item with words."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    rows = rows.select(F.xxhash64("item_id", "text").alias("item"), "item_id", words(F.col("text")).alias("w"))
    return rows.withColumn("item_words", F.size("w")).where("item_words > 0")


def build_index(documents: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the postings of ``terms`` (term, term_id): doc_id, text_hash, n_words, pos, term_id. Position 0 of every
    document is its header, words stand from 1 on. Catalyst broadcasts the terms if they are small."""
    text = F.col(text_col).cast("string")
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words(text).alias("w"))
    tokens = docs.select(*DOC, F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(HEADER)), "w")).alias("pos", "term"))
    return stage(tokens.join(terms, "term").select(*DOC, "n_words", "pos", "term_id"), "postings")


def number_terms(item_words: DataFrame) -> DataFrame:
    """The distinct terms with a number each; the header is -1."""
    spark = item_words.sparkSession
    distinct = item_words.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id())
    return stage(distinct.unionByName(spark.range(1).select(F.lit(HEADER).alias("term"), F.lit(-1).cast("long").alias("term_id"))), "terms")


def seeds(item_words: DataFrame, frequencies: DataFrame, window: int = WINDOW, count: int = SEEDS) -> DataFrame:
    """The ``count`` rarest positions of every window of every item: item, item_words, ipos, term_id and the number of seeds of the item."""
    rated = item_words.join(frequencies, "term_id", "left").withColumn("df", F.coalesce("df", F.lit(0).cast("long")))
    last = F.greatest(F.col("item_words") - window, F.lit(0))
    starts = F.explode(F.sequence(F.greatest(F.col("ipos") - window + 1, F.lit(0)), F.least(F.col("ipos"), last)))
    rank = F.row_number().over(Window.partitionBy("item", "wstart").orderBy("df", "ipos"))
    rows = rated.withColumn("wstart", starts).withColumn("rank", rank).where(F.col("rank") <= count)
    rows = rows.select("item", "item_words", "ipos", "term_id").distinct()
    return rows.withColumn("seeds", F.count(F.lit(1)).over(Window.partitionBy("item")))


def candidate_diagonals(spots: DataFrame, count: int = SEEDS) -> DataFrame:
    """The stored diagonals of an item in a document on which ``count`` seeds meet, or all of a shorter item."""
    met = spots.groupBy(*DOC, "item", "diag").agg(F.count_distinct("ipos").alias("met"), F.first("item_words").alias("item_words"))
    found = met.where(F.col("met") >= F.least(F.lit(count), "item_words")).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "item", "diag", "item_words")
    return stage(found, "diagonals")


def phrase_matches(documents: DataFrame, diagonals: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, pos: every document position inside an occurrence of a window. The text of a document with
    diagonals is read again, cut to the length of the item and compared with it word by word."""
    text = F.col(text_col).cast("string")
    spots = diagonals.groupBy("_d", "_t").agg(F.collect_list(F.struct("item", "diag", "item_words")).alias("spots"))
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    docs = docs.join(spots, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")))
    # A text is cut into words once, whatever the number of its diagonals.
    parts = docs.select(*DOC, words(F.col("_text")).alias("w"), "spots").select(*DOC, "w", F.explode("spots").alias("s")).select(*DOC, "w", "s.*")
    # Word i of the item stands at word diag + i of the document, counted from 1.
    start = F.greatest(F.col("diag"), F.lit(1))
    parts = parts.select(*DOC, "item", "diag", F.slice("w", start, F.greatest(F.col("item_words") - (start - F.col("diag")), F.lit(0))).alias("part"))
    both = parts.join(items, "item").withColumn("skip", F.greatest(1 - F.col("diag"), F.lit(0)))
    same = F.filter(F.sequence(F.lit(0), F.size("part") - 1), lambda i: F.get("part", i) == F.get("w", i + F.col("skip")))
    hits = both.where(F.size("part") > 0).select(*DOC, "item", "item_id", "item_words", "diag", F.explode(F.transform(same, lambda i: i + F.col("skip"))).alias("ipos")).distinct()
    line = Window.partitionBy(*DOC, "item", "diag").orderBy("ipos")
    runs = hits.withColumn("run", F.col("ipos") - F.row_number().over(line))
    length = F.count(F.lit(1)).over(Window.partitionBy(*DOC, "item", "diag", "run"))
    return runs.withColumn("length", length).where(F.col("length") >= F.least(F.lit(window), "item_words")).select(*DOC, "item_id", (F.col("diag") + F.col("ipos")).alias("pos"))


def seed_diagonals(postings: DataFrame, seed_rows: DataFrame, count: int = SEEDS, slop: int = SLOP, near: int = NEAR_SEEDS) -> DataFrame:
    """The stored offset-adjusted lists of the seeds, without the entries that have fewer others within ``slop`` diagonals on
    either side than the weaker of both matches needs. All entries of a match stay; the lists are shuffled once for both."""
    lists = postings.where("pos > 0").join(seed_rows, "term_id")
    least = F.least(F.lit(count), F.lit(near), "seeds").alias("least")
    spots = lists.select(*DOC, "item", "item_words", "ipos", (F.col("pos") - F.col("ipos")).alias("diag"), least)
    around = Window.partitionBy(*DOC, "item").orderBy("diag").rangeBetween(-slop, slop)
    return stage(spots.withColumn("met", F.count(F.lit(1)).over(around)).where("met >= least").drop("met", "least"), "spots")


def proximity_matches(spots: DataFrame, seed_rows: DataFrame, slop: int = SLOP, near: int = NEAR_SEEDS) -> DataFrame:
    """doc_id, text_hash, item: at least ``near`` different seeds of the item (all of an item with fewer) in the order of the
    item up to ``slop`` shifts, that is on diagonals at most ``slop`` apart."""
    # Diagonals at most slop apart share a block of 2 * slop in one of two tilings shifted by slop.
    tiles = spots.distinct().withColumn("tile", F.explode(F.array(F.floor(F.col("diag") / (2 * slop)) * 2, F.floor((F.col("diag") + slop) / (2 * slop)) * 2 + 1)))
    seeds_of = seed_rows.select("item", "seeds").distinct()
    tile = Window.partitionBy(*DOC, "item", "tile").orderBy("diag").rangeBetween(0, slop)
    counted = tiles.withColumn("met", F.size(F.collect_set("ipos").over(tile)))
    best = counted.groupBy(*DOC, "item").agg(F.max("met").alias("met"))
    return best.join(seeds_of, "item").where(F.col("met") >= F.least(F.lit(near), "seeds")).select(*DOC, "item")


def decontaminate(documents: DataFrame, items: DataFrame, window: int = WINDOW, count: int = SEEDS, id_col: str = "doc_id", text_col: str = "text", proximity: bool = True) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated and, if asked for, n_near_items (items with a
    proximity match) for every document row."""
    texts = stage(item_texts(items), "items")
    listed = texts.select("item", "item_words", F.posexplode("w").alias("ipos", "term"))
    terms = number_terms(listed)
    item_words = stage(listed.join(terms, "term").drop("term"), "item-terms")
    postings = build_index(documents, terms, id_col, text_col)
    frequencies = postings.where("pos > 0").groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    seed_rows = stage(seeds(item_words, frequencies, window, count), "seeds")
    spots = seed_diagonals(postings, seed_rows, count)
    diagonals = candidate_diagonals(spots, count)
    matches = stage(phrase_matches(documents, diagonals, texts, window, id_col, text_col), "matches")
    hits = matches.groupBy(*DOC).agg(F.count_distinct("pos").alias("n_hit"))
    names = matches.select(*DOC, "item_id").distinct().groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",").alias("ids"))
    headers = postings.where("pos = 0").select(*DOC, "n_words")
    counted = [hits, names]
    if proximity:
        counted.append(proximity_matches(spots, seed_rows).groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_near_items")))
    rows = headers
    for more in counted:
        more = more.withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"})
        rows = rows.join(more, rows["doc_id"].eqNullSafe(more["_d"]) & rows["text_hash"].eqNullSafe(more["_t"]), "left").drop("_d", "_t")
    zero = F.lit(0).cast("long")
    return rows.select(
        *DOC, F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        *([F.coalesce("n_near_items", zero).alias("n_near_items")] if proximity else []),
    )


def clean_rows(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` that hold no window of an item, with their columns."""
    hit = decontaminate(documents, items, id_col=id_col, text_col=text_col, proximity=False).where("contaminated")
    return without_rows(documents, hit, id_col, text_col)
