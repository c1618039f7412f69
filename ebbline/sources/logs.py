"""Event logs and product table: contracts, typed readers, and one unified activity table.

``activity`` has the columns ``client_id, ts, event, sku, url, query``. ``event`` is a literal per
log, so a filter on it removes whole files from the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.config import ALL_EVENTS, BUY, CART, PAGE, PRODUCT_EVENTS, REMOVE, SEARCH
from ebbline.functions.scalar import UNIFORM_KEY_RANGE, to_event_time, uniform_key

# The attribute column of each log.
LOG_ATTRIBUTE = {BUY: "sku", CART: "sku", REMOVE: "sku", PAGE: "url", SEARCH: "query"}
ATTRIBUTE_TYPE = {"sku": "bigint", "url": "bigint", "query": "string"}

ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event", T.StringType()),
        T.StructField("sku", T.LongType()),
        T.StructField("url", T.LongType()),
        T.StructField("query", T.StringType()),
    ]
)
PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("sku", T.LongType()),
        T.StructField("category", T.LongType()),
        T.StructField("price", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}")


def find_parquet(spark: SparkSession, root: str, stem: str) -> str:
    """Path of ``stem.parquet`` (file or folder) at or below ``root``, however deep; the first in sort order.

    Folders are listed through Spark's file systems, so any store it reads will do. A folder of that name is a table
    and not searched further; hidden folders and those of partition columns hold none.
    """
    jvm, context = spark._jvm, spark.sparkContext
    top = jvm.org.apache.hadoop.fs.Path(root)
    store = top.getFileSystem(context._jsc.hadoopConfiguration())
    found, folders = [], [top] if store.exists(top) else []
    while folders:
        for entry in store.listStatus(folders.pop()):
            name = entry.getPath().getName()
            if name == f"{stem}.parquet":
                found.append(entry.getPath().toString())
            elif entry.isDirectory() and name[:1] not in "._" and "=" not in name and not name.endswith(".parquet"):
                folders.append(entry.getPath())
    if not found:
        raise FileNotFoundError(f"no {stem}.parquet under {root}")
    return min(found)


def whole(column: Column, dtype: T.DataType) -> Column:
    """The column as a whole number; fractions are rounded, halves to the even neighbour."""
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        column = F.bround(column, 0)
    return column.cast("bigint")


def typed_log(raw: DataFrame, event: str) -> DataFrame:
    """One log in activity form. Rows without client (or sku, in product logs) are dropped;
    bad times become NULL and never match a window."""
    attribute = LOG_ATTRIBUTE[event]
    require_columns(raw, ["client_id", "timestamp", attribute], event)
    kept = raw.filter(F.col("client_id").isNotNull())
    if event in PRODUCT_EVENTS:
        kept = kept.filter(F.col("sku").isNotNull())
    if attribute == "query" and isinstance(raw.schema["query"].dataType, T.ArrayType):
        kept = kept.withColumn("query", F.concat(F.lit("["), F.array_join("query", ", ", "NULL"), F.lit("]")))
    columns = {
        "client_id": whole(F.col("client_id"), raw.schema["client_id"].dataType),
        "ts": to_event_time(F.col("timestamp")),
        "event": F.lit(event),
    }
    for name, dtype in ATTRIBUTE_TYPE.items():
        value = F.col(name) if name == attribute else F.lit(None)
        columns[name] = whole(value, raw.schema[name].dataType) if name == attribute and dtype == "bigint" else value.cast(dtype)
    return kept.select([c.alias(n) for n, c in columns.items()])


def read_logs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {event: typed_log(raw, event) for event, raw in raw_logs(spark, root).items()}


def unify(logs: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, logs.values())


def register_views(frames: dict[str, DataFrame]) -> None:
    """Name the typed logs (and products) for SQL users; views stay lazy."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def read_activity(spark: SparkSession, root: str) -> DataFrame:
    return unify(read_logs(spark, root))


def sample_clients(activity: DataFrame, fraction: float | None, seed: int = 42) -> DataFrame:
    """Keep whole clients with probability ``fraction``; sampling rows would bend per-client features."""
    if fraction is None or not 0 < fraction < 1:
        return activity
    return activity.filter(uniform_key(seed, "client_id") < int(fraction * UNIFORM_KEY_RANGE))


def cleaned_log(activity: DataFrame, event: str, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Strict single-log form: rows without a valid time are dropped, a missing url is -1,
    and rows are sampled when a fraction is given."""
    attribute = LOG_ATTRIBUTE[event]
    log = activity.filter((F.col("event") == event) & F.col("ts").isNotNull())
    value = F.coalesce("url", F.lit(-1)) if attribute == "url" else F.col(attribute)
    log = log.select("client_id", F.col("ts").alias("timestamp"), value.alias(attribute))
    if fraction is not None and 0 < fraction < 1:
        log = log.sample(fraction=fraction, seed=seed)
    return log


def cleaned_logs(activity: DataFrame, fraction: float | None = None, seed: int = 42) -> dict[str, DataFrame]:
    return {e: cleaned_log(activity, e, fraction, seed) for e in ALL_EVENTS}


def typed_products(raw: DataFrame, unique: bool = True) -> DataFrame:
    """Product table in contract form. With ``unique`` one row per sku is kept: complete rows
    first, then the smallest, so the choice does not depend on file order."""
    require_columns(raw, ["sku"], "product table")

    def optional(name: str, dtype: str):
        column = F.col(name).try_cast(dtype) if name in raw.columns else F.lit(None).cast(dtype)
        return column.alias(name)

    extra = ["embedding"] if "embedding" in raw.columns else []
    products = raw.filter(F.col("sku").isNotNull()).select(
        whole(F.col("sku"), raw.schema["sku"].dataType).alias("sku"),
        optional("category", "bigint"),
        optional("price", "double"),
        *extra,
    )
    if not unique:
        return products
    preference = F.struct(
        F.col("category").isNull().alias("no_category"), F.col("price").isNull().alias("no_price"), "category", "price", *extra
    )
    columns = ["category", "price", *extra]
    best = products.groupBy("sku").agg(F.min(preference).alias("best"))
    return best.select("sku", *[f"best.{c}" for c in columns])


def read_products(spark: SparkSession, root: str) -> DataFrame:
    return typed_products(spark.read.parquet(find_parquet(spark, root, "product_properties")))


def event_volume(activity: DataFrame) -> DataFrame:
    """Rows per log, largest first, in one pass over the event column."""
    known = activity.filter(F.col("event").isin(*ALL_EVENTS))
    return known.groupBy("event").agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "event")


def footer_volume(spark: SparkSession, root: str) -> DataFrame:
    """Rows per stored log, largest first, from the Parquet footers: no row is read. The counts are pushed down by the second
    generation of Spark's file sources, which is switched on in a session of its own."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = [own.read.parquet(find_parquet(spark, root, e)).agg(F.count("*").alias("n_rows")).select(F.lit(e).alias("event"), "n_rows") for e in ALL_EVENTS]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("n_rows"), "event")


def time_quality(raw: DataFrame, time: str = "timestamp") -> DataFrame:
    """How many rows of a log have a time, have none, and have one that can't be read (they become NULL and match no window), with
    the first and last day of the others."""
    parsed = raw.select(F.col(time).isNull().alias("none"), to_event_time(F.col(time)).alias("ts"))
    return parsed.agg(
        F.count("ts").alias("n_times"),
        F.count_if("none").alias("n_missing"),
        F.count_if(~F.col("none") & F.col("ts").isNull()).alias("n_unreadable"),
        F.to_date(F.min("ts")).alias("first_day"),
        F.to_date(F.max("ts")).alias("last_day"),
    )


def raw_events(raw: dict[str, DataFrame]) -> DataFrame:
    """The name of its log for every raw row; no column of the files is read."""
    return reduce(DataFrame.unionByName, [log.select(F.lit(e).alias("event")) for e, log in raw.items()])


def raw_logs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {e: spark.read.parquet(find_parquet(spark, root, e)) for e in ALL_EVENTS}
