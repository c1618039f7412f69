"""Mix sources to target weights by systematic sampling.

The size of a text is its number of words (maximal runs without ASCII white space); null texts have size 0. Sources
in code point order, null last, weigh WEIGHTS in turn and share ``share`` times all sizes by weight. A target stops at
``most`` times its source's size; what is above is shared again by weight among the others until none is above.

Every document of a source has the same expected number of copies r = target / source size. Along an order of the source's
documents (size class, then hash bucket, then size), the expected copies are summed from the front, one random offset
per source is added, and a document is taken once for every whole number its sum passes. So a document is taken floor(r) or
ceil(r) times, at most ``most`` times, and because neighbours have like sizes the taken words come near the target.

No task holds a source: sums run inside cells of about sqrt(n) rows and over the cells' counts. The order and the offset
are hashes of content, so reruns agree. Repeated rows are documents of their own. An empty table gives no rows; a source
whose sizes are all 0 has target 0 and is not taken. Other columns are carried along by ``mix`` and may have any name that does
not begin with ``_mix_``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbline.llm.common import quoted, unused
from ebbline.session import stage

WEIGHTS = (5, 2, 1)
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``). ``share`` is a fraction (numerator, denominator).

    Sources are capped in the order of size by weight: one is capped if its share of what the earlier ones leave
    is at least its cap. Whole numbers until the last division.
    """
    up, down = share
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("_w", weight)
    order = [F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last()]
    everything = Window.partitionBy()
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_total": F.sum("source_size").over(everything), "_weights": F.sum("_w").over(everything), "_c": F.coalesce(F.sum("source_size").over(before), F.lit(0).cast("long")), "_b": F.coalesce(F.sum("_w").over(before), F.lit(0).cast("long"))})
    # all numbers times `down`
    left = up * F.col("_total") - down * most * F.col("_c")
    rows = rows.withColumn("_capped", left * F.col("_w") >= down * most * F.col("source_size") * (F.col("_weights") - F.col("_b")))
    rows = rows.withColumns({"_cut": F.sum(F.when(F.col("_capped"), F.col("source_size")).otherwise(0)).over(everything), "_open": F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("_w"))).over(everything)})
    rest = (F.col("_w") * (up * F.col("_total") - down * most * F.col("_cut"))).cast("double") / (down * F.col("_open")).cast("double")
    return rows.select("source", "source_size", F.when(F.col("_capped"), (most * F.col("source_size")).cast("double")).otherwise(rest).alias("target"))


def mix_plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """One narrow row per document: ``doc_id``, ``source``, ``row_hash``, ``size``, ``source_size``, ``target``, ``copies``."""
    narrow = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), row_hash(df).alias("row_hash"), word_count(F.col(text_col)).alias("size"))
    narrow = stage(narrow.withColumn("_class", F.length(F.bin("size"))), "mix-sizes")
    classes = narrow.groupBy("source", "_class").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_size"))
    classes = stage(classes.withColumn("_buckets", F.ceil(F.sqrt("_n")).cast("long")), "mix-classes")
    sources = targets(classes.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, share, most)

    bucket = F.pmod("row_hash", "_buckets").alias("_bucket")
    placed = _same(narrow, classes.select("source", "_class", "_buckets"), "source", "_class").select("doc_id", "source", "row_hash", "size", "_class", bucket)
    counts = placed.groupBy("source", "_class", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = lambda keys, order, n: F.coalesce(F.sum(n).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    class_ahead = classes.select("source", "_class", ahead(["source"], "_class", "_n").alias("_class_ahead"))
    cells = counts.withColumn("_cell_ahead", ahead(["source", "_class"], "_bucket", "_rows")).drop("_rows")
    cells = _same(cells, class_ahead, "source", "_class")
    cells = _same(cells, sources, "source").withColumns({"_ahead": F.col("_class_ahead") + F.col("_cell_ahead"), "_offset": _uniform(F.col("source"), seed)})
    cells = stage(cells.select("source", "_class", "_bucket", "_ahead", "_offset", "source_size", "target"), "mix-cells")

    within = Window.partitionBy("source", "_class", "_bucket").orderBy("size", "row_hash", "doc_id")
    ranked = placed.withColumn("_k", F.row_number().over(within))
    ranked = _same(ranked, cells, "source", "_class", "_bucket").withColumn("_k", F.col("_k") + F.col("_ahead"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    part = ratio - F.floor(ratio)
    passed = F.floor(F.col("_offset") + part * F.col("_k")) - F.floor(F.col("_offset") + part * (F.col("_k") - 1))
    return ranked.select("doc_id", "source", "row_hash", "size", "source_size", "target", (F.floor(ratio) + passed).cast("long").alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it, with the columns of ``df``."""
    plan = mix_plan(df, id_col=id_col, **settings).where("copies > 0")
    one, named, hashed, copies, copy = unused(df, "_mix_row", "_mix_id", "_mix_hash", "_mix_copies", "_mix_copy")
    plan = plan.groupBy(F.col("doc_id").alias(named), F.col("row_hash").alias(hashed)).agg(F.sum("copies").alias(copies))
    rows = df.withColumn(one, row_hash(df)).dropDuplicates([id_col, one])
    joined = rows.join(plan, F.col(id_col).eqNullSafe(F.col(named)) & (F.col(one) == F.col(hashed)))
    return joined.select(*quoted(df), F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int"))).alias(copy)).drop(copy)


def row_hash(df: DataFrame) -> Column:
    """A number below 2^60 from the whole row."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in quoted(df)]
    return _number(F.concat_ws("\1", *parts), 15)


def _number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _uniform(source: Column, seed: int) -> Column:
    return _number(F.concat_ws("\1", F.coalesce(source, F.lit("\0")), F.lit(str(seed))), 7) / F.lit(float(1 << 28))


def _same(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join on equal or both null keys, with the keys once."""
    other = right.select(*(F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns))
    match = None
    for key in keys:
        one = left[key].eqNullSafe(other[f"_r_{key}"])
        match = one if match is None else match & one
    return left.join(other, match).drop(*(f"_r_{k}" for k in keys))
