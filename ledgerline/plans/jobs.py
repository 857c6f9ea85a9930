"""End-to-end jobs of the reference, as Spark plans.

Each job returns its result frames; ``write_*`` variants also write them.
A frame that feeds several outputs is written once as a Parquet table in the
shared checkpoint folder (cuts the lineage, survives lost executors) before
the outputs, instead of being recomputed per output.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.operators import aggregate as agg
from ledgerline.operators import clean, dedup
from ledgerline.operators import quality as Q
from ledgerline.operators.inspect import observed
from ledgerline.session import scratch_table
from ledgerline.sources import csv as C
from ledgerline.sources import sinks
from ledgerline.sources.publish import publish

DEFAULT_THRESHOLD = 5000


def _pandas_sum(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df.groupby(key)[value].sum()``: rows with a missing key form no
    group, missing values are skipped, an all-missing group sums to 0."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.coalesce(F.sum(value), F.lit(0)).alias(name)))


# E01 -------------------------------------------------------------------------
def clean_sales_data(df: DataFrame, region: str = "West", min_quantity: int = 1) -> DataFrame:
    """filter (region and quantity > n) -> drop missing quantity -> drop
    duplicate rows."""
    kept = df.where((F.col("region") == region) & (F.col("quantity") > min_quantity))
    return dedup.drop_duplicates(kept.na.drop(subset=["quantity"]), mostly_distinct=True)


# E02 -------------------------------------------------------------------------
def sales_analytics(df: DataFrame, top_n: int = 2) -> dict[str, DataFrame]:
    """revenue -> per product, per region, top n products.  No cleaning: a
    missing revenue is skipped by the sums (a group of only missing sums to 0)."""
    s = agg.with_revenue(df)
    prod = _pandas_sum(s, "product", "revenue", "total_revenue")
    reg = _pandas_sum(s, "region", "revenue", "total_revenue")
    top = prod.orderBy(F.desc("total_revenue"), "product").limit(top_n)
    # printed totals: over every row, also rows whose group key is missing;
    # a missing revenue is skipped (pandas sum / mean)
    totals = s.agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
                   F.avg("revenue").alias("average_order_value"))
    return {"product": prod, "region": reg, "top": top, "totals": totals}


# E03 -------------------------------------------------------------------------
def regional_sales(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> dict[str, DataFrame]:
    """drop missing quantity -> to numeric -> drop duplicates -> revenue ->
    per region revenue + quantity (renamed, sorted) -> low performers."""
    c = clean.to_numeric(df.na.drop(subset=["quantity"]), "quantity", "price")
    c = agg.with_revenue(dedup.drop_duplicates(c, mostly_distinct=True))
    summary = (c.where(F.col("region").isNotNull()).groupBy("region")
               .agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("Total_Revenue"),
                    F.coalesce(F.sum("quantity"), F.lit(0)).alias("Total_Quantity"))
               .withColumnRenamed("region", "Region")
               .orderBy(F.desc("Total_Revenue"), "Region"))
    low = summary.where(F.col("Total_Revenue") < F.lit(threshold))
    return {"summary": summary, "low": low}


# E04 -------------------------------------------------------------------------
def clean_and_aggregate(df: DataFrame) -> dict[str, DataFrame]:
    """drop duplicates -> drop missing quantity -> to numeric -> revenue ->
    per product and per region, sorted by revenue."""
    c = clean.to_numeric(dedup.drop_duplicates(df, mostly_distinct=True).na.drop(subset=["quantity"]),
                         "quantity", "price")
    c = agg.with_revenue(c)
    return {"clean": c, **clean_and_aggregate_from_clean(c)}


# E05 -------------------------------------------------------------------------
def zip_arrays(df: DataFrame, arrays: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Rows from equal-length array columns zipped by position (S06).
    Arrays of different lengths raise instead of being padded with NULL."""
    names = list(arrays)
    sizes = [F.size(arrays[n]) for n in names]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    z = F.arrays_zip(*[F.col(arrays[n]).alias(n) for n in names])
    # the check sits inside the zipped value, so no projection can prune it
    z = F.when(same, z).otherwise(F.raise_error(F.lit("arrays of different lengths")))
    return df.select(*(keep or []), F.inline(z))


def vectorized_rules(df: DataFrame, high: float = rules.VALUE_HIGH_ABOVE,
                     medium: float = rules.VALUE_MEDIUM_FROM,
                     keep: list[str] | None = None) -> DataFrame:
    """Arrays ``prices`` / ``quantities`` -> rows (price, quantity, revenue,
    category) with the long class labels."""
    rows = zip_arrays(df, {"price": "prices", "quantity": "quantities"}, keep)
    return (agg.with_revenue(rows)
            .withColumn("category", rules.value_class("revenue", high, medium)))


def array_rules(df: DataFrame, prices: str = "prices", quantities: str = "quantities",
                high: float = rules.VALUE_HIGH_ABOVE, medium: float = rules.VALUE_MEDIUM_FROM) -> DataFrame:
    """The array rules as kernels: every row of ``df`` with arrays revenue
    and category, their length, the revenue's sum and how many are of the
    highest class.  Nothing is exploded, so no row moves.  A missing element
    gives a missing revenue of the lowest class; arrays of different lengths
    raise."""
    same = F.size(prices) == F.size(quantities)
    revenue = F.when(same | F.col(prices).isNull() | F.col(quantities).isNull(),
                     F.zip_with(prices, quantities, lambda p, q: p * q)) \
        .otherwise(F.raise_error(F.lit("arrays of different lengths")))
    out = df.withColumn("revenue", revenue)
    out = out.withColumn("category", F.transform("revenue", lambda r: rules.value_class(r, high, medium)))
    zero = F.lit(0).cast(out.schema["revenue"].dataType.elementType)
    return (out.withColumn("items", F.coalesce(F.array_size("revenue"), F.lit(0)))
            .withColumn("total_revenue", F.aggregate(F.col("revenue"), zero, lambda a, x: a + F.coalesce(x, zero)))
            .withColumn("high_items", F.coalesce(F.size(F.filter(
                "category", lambda c: c == rules.VALUE_LABELS[0])), F.lit(0))))


def array_rules_csv(classified: DataFrame, path: str, sep: str = ";") -> str:
    """Header CSV of ``array_rules``: arrays as text, elements joined."""
    def text(c):
        kind = classified.schema[c].dataType
        return F.array_join(F.col(c).cast("array<string>"), sep, "") if kind.typeName() == "array" else F.col(c)

    return sinks.write_csv(classified.select(*[text(c).alias(c) for c in classified.columns]), path)


# E06 -------------------------------------------------------------------------
def category_distribution(classified: DataFrame, col: str = "category") -> DataFrame:
    """Rows per class, most frequent first (``value_counts``) with the
    summary totals of the rule jobs: rows and revenue per class."""
    return (classified.groupBy(col)
            .agg(F.count(F.lit(1)).alias("count"),
                 F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"))
            .orderBy(F.desc("count"), col))


def business_rules_engine(df: DataFrame, high: float = rules.VALUE_HIGH_ABOVE,
                          medium: float = rules.VALUE_MEDIUM_FROM) -> DataFrame:
    """(transaction_id, price, quantity) -> (transaction_id, revenue,
    category) with the short labels."""
    r = agg.with_revenue(df)
    return r.select("transaction_id", "revenue",
                    rules.value_class("revenue", high, medium, rules.SHORT_LABELS)
                    .alias("category"))


# E07 -------------------------------------------------------------------------
def analyze_csv(spark, path: str, report_dir: str | None = None) -> DataFrame:
    """Quality report of one CSV file (all columns as text).  The error form
    (status, error_message, file_path, analysis_date) is returned when the
    file cannot be read; only a successful report is written."""
    audit = C.load_audit(spark, [path]).first()
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if audit is None or (not audit.success and audit.error != C.AUDIT_NO_ROWS):
        msg = audit.error if audit is not None else "Unexpected error"
        return spark.range(1).select(F.lit("error").alias("status"),
                                     F.lit(msg).alias("error_message"),
                                     F.lit(path).alias("file_path"), now.alias("analysis_date"))
    raw = C.read_csv_raw(spark, path)
    cols = [c for c in raw.columns if c != "malformed"]
    ordered = C.with_row_ordinal(raw, "_row")
    name = posixpath.basename(path)
    target = sinks.report_path(report_dir, name) if report_dir else None
    rep = Q.quality_report(ordered, cols, "_row", name, path, audit.size_bytes,
                           duplicates_path=target and target.removesuffix(".json") + "_duplicate_rows")
    if report_dir:
        sinks.write_json_report(rep, target)
    return rep


# file to file ----------------------------------------------------------------
# Each runner reads CSV, writes its shared frame once to a scratch table (deleted
# at the end) and publishes all of its outputs together (``sources.publish``): a
# run that fails leaves the outputs of the run before it.  Rows in and out of a
# step are observed on the one write of the shared frame.

SALES_FILE = "order_id INT, region STRING, product STRING, quantity DOUBLE, price DOUBLE"
RULES_FILE = "transaction_id STRING, price BIGINT, quantity BIGINT"
ROW = "_row"


def _typed(spark, path: str, schema: str) -> DataFrame:
    return C.read_csv_typed(spark, path, schema).drop("malformed", "bad_cells")


def _in_file_order(df: DataFrame) -> DataFrame:
    """Rows by their ordinal, over part files in the order of their names:
    a range shuffle, never one task."""
    return df.orderBy(ROW).drop(ROW)


def run_clean_users(spark, in_path: str, out_dir: str) -> dict:
    """V07 end to end: the users CSV (every column as text) with its kept rows
    cleaned, in the order of the input and with its columns.  Returns
    {"paths", "steps": {"loaded", "kept"}}."""
    raw, o_in = observed(C.with_row_ordinal(C.read_csv_raw(spark, in_path).drop("malformed"), ROW), "loaded")
    kept, o_out = observed(clean.clean_users(raw), "kept")
    with scratch_table(kept, "clean_users") as rows:
        paths = publish(spark, out_dir, {"clean_users": _in_file_order(rows)})
    return {"paths": paths, "steps": {"loaded": o_in.get["rows"], "kept": o_out.get["rows"]}}


def run_clean_sales(spark, in_path: str, out_dir: str, region: str = "West", min_quantity: int = 1,
                    schema: str = SALES_FILE) -> dict:
    """E01 end to end: filter, drop missing quantity, drop duplicates; the
    first of equal rows stays, in the order of the input.  Returns {"paths",
    "steps": {"loaded", "filtered", "distinct"}}."""
    rows, o_in = observed(C.with_row_ordinal(_typed(spark, in_path, schema), ROW), "loaded")
    kept = rows.where((F.col("region") == region) & (F.col("quantity") > min_quantity))
    kept, o_kept = observed(kept.na.drop(subset=["quantity"]), "filtered")
    cols = [c for c in rows.columns if c != ROW]
    dealt = kept.repartition(dedup.distinct_tasks(kept), *cols)
    first, o_first = observed(dealt.groupBy(*cols).agg(F.min(ROW).alias(ROW)), "distinct")
    with scratch_table(first, "clean_sales") as out:
        paths = publish(spark, out_dir, {"clean_sales": _in_file_order(out)})
    steps = {n: o.get["rows"] for n, o in (("loaded", o_in), ("filtered", o_kept), ("distinct", o_first))}
    return {"paths": paths, "steps": steps}


def run_sales_analytics(spark, in_path: str, out_dir: str, top_n: int = 2, schema: str = SALES_FILE) -> dict:
    """E02 end to end: revenue per product, per region and the top products.
    One aggregate by (product, region) is written, and every output and the
    totals come from it.  Returns {"paths", "totals": {total_revenue,
    average_order_value}}."""
    s = agg.with_revenue(_typed(spark, in_path, schema))
    cells = s.groupBy("product", "region").agg(F.sum("revenue").alias("revenue"), F.count("revenue").alias("priced"))
    with scratch_table(cells, "sales_analytics") as c:
        product = _pandas_sum(c, "product", "revenue", "total_revenue").orderBy(F.desc("total_revenue"), "product")
        per_region = _pandas_sum(c, "region", "revenue", "total_revenue").orderBy(F.desc("total_revenue"), "region")
        paths = publish(spark, out_dir, {"revenue_per_product": product, "revenue_per_region": per_region,
                                         "top_products": product.limit(top_n)})
        totals = c.agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
                       F.try_divide(F.sum("revenue"), F.sum("priced")).alias("average_order_value")).first()
    return {"paths": paths, "totals": totals.asDict()}


def run_business_rules(spark, in_path: str, out_dir: str, high: float = rules.VALUE_HIGH_ABOVE,
                       medium: float = rules.VALUE_MEDIUM_FROM, schema: str = RULES_FILE) -> dict:
    """E06 end to end: revenue and class per transaction, in the order of the
    input, and rows and revenue per class.  Returns {"paths", "steps"}."""
    rows, o_in = observed(C.with_row_ordinal(_typed(spark, in_path, schema), ROW), "loaded")
    out = agg.with_revenue(rows).select(
        ROW, "transaction_id", "revenue",
        rules.value_class("revenue", high, medium, rules.SHORT_LABELS).alias("category"))
    with scratch_table(out, "business_rules") as t:
        paths = publish(spark, out_dir, {"classified_transactions": _in_file_order(t),
                                         "category_summary": category_distribution(t)})
    return {"paths": paths, "steps": {"loaded": o_in.get["rows"]}}


def run_clean_and_aggregate(spark, in_path: str, out_dir: str, schema: str = SALES_FILE) -> dict:
    """E04 end to end: typed CSV in, three CSV outputs.  The clean frame is
    written once and the two aggregates read it, so dedup and cleaning run
    once however many outputs use them.  Rows in and out of each step are
    observed on that one write (no extra jobs).
    Returns {"paths": {output: folder}, "steps": {step: rows}}."""
    df, o_in = observed(_typed(spark, in_path, schema), "loaded")
    dd, o_dd = observed(dedup.drop_duplicates(df, mostly_distinct=True), "drop_duplicates")
    kept, o_na = observed(dd.na.drop(subset=["quantity"]), "dropna_quantity")
    clean_df = agg.with_revenue(clean.to_numeric(kept, "quantity", "price"))
    with scratch_table(clean_df, "clean_sales") as shared:
        steps = {n: o.get["rows"] for n, o in (("loaded", o_in), ("drop_duplicates", o_dd),
                                               ("dropna_quantity", o_na))}
        paths = publish(spark, out_dir, {"clean": shared, **clean_and_aggregate_from_clean(shared)})
    return {"paths": paths, "steps": steps}


def clean_and_aggregate_from_clean(c: DataFrame) -> dict[str, DataFrame]:
    prod = (_pandas_sum(c, "product", "revenue", "total_revenue")
            .orderBy(F.desc("total_revenue"), "product"))
    reg = (_pandas_sum(c, "region", "revenue", "total_revenue")
           .orderBy(F.desc("total_revenue"), "region"))
    return {"product": prod, "region": reg}


def run_regional(spark, in_path: str, out_dir: str, threshold: float = DEFAULT_THRESHOLD,
                 schema: str = SALES_FILE) -> dict[str, str]:
    """E03 end to end: the small regional summary is written once, then
    published whole and as the low-performer split (a header-only file when
    no region is below the threshold)."""
    with scratch_table(regional_sales(_typed(spark, in_path, schema), threshold)["summary"], "regional") as t:
        summ = t.orderBy(F.desc("Total_Revenue"), "Region")
        low = summ.where(F.col("Total_Revenue") < F.lit(threshold))
        return publish(spark, out_dir, {"regional_revenue_summary": summ, "low_performing_regions": low})
