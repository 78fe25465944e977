"""The whole run over one lake root: bronze, silver with quality gate, gold, post-load check.

Each step reads what earlier steps wrote, so a run can be repeated from any
layer. Tables of silver, quality and gold are versioned: a step that fails leaves
the version before, and readers are never cut off.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from stockpond.contracts import GOLD_PARTITIONS, MART_TABLES, SILVER_TABLES, LakeConfig, source_table
from stockpond.plans import dimensions, facts, marts
from stockpond.plans.bronze import ingest_table
from stockpond.plans.silver import build_silver, merge_silver
from stockpond.quality.engine import enforce
from stockpond.quality.keys import check_keys, key_counters
from stockpond.quality.suites import check_customers, check_order_items, check_orders, check_products
from stockpond.operators.history import merge_history
from stockpond.operators.numbering import number_rows
from stockpond.session import scratch_scope, shuffle_sizing
from stockpond.sources.catalog import register_table
from stockpond.sources.files import is_empty_source, path_exists, read_layer
from stockpond.sources.quarantine import FailureBudget, ingest_with_quarantine
from stockpond.sources.sinks import WriteReport, write_table
from stockpond.streaming.incremental import ingest_new_files
from stockpond.sources.versions import current_version, merge_buckets, remove_old_versions, replace_buckets, replace_table

log = logging.getLogger(__name__)

#: Silver tables with columns that move on from day to day in every row (ages).
DAILY_CHANGING = ("customers",)


def run_bronze(
    spark: SparkSession,
    lake: LakeConfig,
    tables: Sequence[str] = SILVER_TABLES,
    file_format: str = "csv",
    replace_day: bool = False,
    incremental: bool = False,
    match_pattern: bool = False,
    budget: FailureBudget | None = None,
    run_id: str | None = None,
) -> dict[str, WriteReport | None]:
    """Ingest the raw folders of the given tables.

    ``incremental`` takes in only the files that no incremental run took in
    before; it may follow plain runs, whose files it does not know.
    ``match_pattern`` reads only files named like their table. With a ``budget``
    malformed records go to the quarantine layer, and a delivery with more of
    them than it allows is refused; ``run_id`` names such a run, so that it adds its rows once.
    """
    if budget is not None and (incremental or replace_day or not run_id):
        raise ValueError("a run with a budget needs a run_id, and is neither incremental nor replaces a day")
    if incremental and replace_day:
        raise ValueError("an incremental run adds to its day and cannot replace it")

    def ingest(table: str) -> WriteReport | None:
        name, raw, bronze = source_table(table).name, lake.path("raw", table), lake.path("bronze", table)
        if budget is not None:
            kept = ingest_with_quarantine(spark, name, raw, bronze, lake.path("quarantine", table), run_id, budget,
                                          file_format, match_pattern=match_pattern)
            return kept and WriteReport(bronze, kept.accepted, {"quarantined": kept.quarantined})
        if not incremental:
            return ingest_table(spark, name, raw, bronze, file_format, replace_day, match_pattern)
        if not path_exists(spark, raw):
            log.warning("%s: no raw files at %s, skipped", table, raw)
            return None
        rows = ingest_new_files(spark, name, raw, bronze, lake.path("checkpoints", table), file_format,
                                match_pattern=match_pattern)
        return WriteReport(bronze, rows, {})

    return {table: ingest(table) for table in tables}


def run_silver(
    spark: SparkSession,
    lake: LakeConfig,
    tables: Sequence[str] = SILVER_TABLES,
    as_of: str | None = None,
    processing_date: str | None = None,
) -> dict[str, WriteReport | None]:
    """Build silver tables from bronze.

    With a ``processing_date`` only that ingestion day is read and merged into
    the existing silver table; otherwise the table is rebuilt. The merge
    rewrites only the buckets of the keys that arrived, except for tables whose
    rows depend on the day of the run. Shuffles are sized by the bronze files
    that are read. Rows are written by the tasks that deduplicated them, so
    they are shuffled once.
    """
    return {table: _silver_table(spark, lake, table, as_of, processing_date) for table in tables}


def _silver_table(spark, lake, table, as_of, processing_date) -> WriteReport | None:
    source_table(table)
    source, target = lake.path("bronze", table), lake.path("silver", table)
    if not path_exists(spark, source):
        log.warning("%s: no bronze table, skipped", table)
        return None
    bronze = read_layer(spark, source, processing_date)
    if is_empty_source(bronze):
        log.warning("%s: no bronze records, skipped", table)
        return None
    silver, key = build_silver(table, bronze, as_of), source_table(table).key
    if not processing_date or not path_exists(spark, target):
        with shuffle_sizing(spark, [bronze]):
            return replace_buckets(silver, target, key, lake.silver_buckets, gather=False)
    version, existing = current_version(spark, target), read_layer(spark, target)
    if version is None or not version.buckets or table in DAILY_CHANGING:
        with shuffle_sizing(spark, [bronze, existing]):
            merged = merge_silver(table, existing, silver, as_of)
            return replace_buckets(merged, target, key, lake.silver_buckets, gather=False)
    with scratch_scope(spark), shuffle_sizing(spark, [bronze, existing]):
        return merge_buckets(
            target, silver, lambda existing, arrivals: merge_silver(table, existing, arrivals, as_of), gather=False)


def run_key_gate(
    spark: SparkSession, lake: LakeConfig, tables: Sequence[str] = SILVER_TABLES, processing_date: str | None = None
) -> DataFrame:
    """Count the keys of bronze, one day or all, keep the counters per day, and stop the run if the gate is closed.

    Silver keeps one row per key and none without, so its own key checks
    cannot fail; this one sees what was delivered. With a day, only that day is counted and judged.
    """
    results = None
    for table in tables:
        source, path = lake.path("bronze", table), lake.path("quality", f"bronze_keys_{table}")
        if not path_exists(spark, source):
            log.warning("%s: no bronze table, skipped", table)
            continue
        counters = key_counters(read_layer(spark, source, processing_date), table, source_table(table).key)
        write_table(counters, path, partition_by=["_ingestion_date"], replace_only_written=bool(processing_date), gather=False)
        # A day without rows leaves no counters, so the schema may not be read from files.
        written = spark.read.schema(counters.schema).parquet(path)
        found = check_keys(written, lake.limits, [processing_date] if processing_date else None)
        results = found if results is None else results.unionByName(found)
    if results is None:
        raise FileNotFoundError("no bronze table to check")
    path = lake.path("quality", "bronze_checks")
    replace_table(results, path)
    checked = read_layer(spark, path)
    if lake.limits.fail_on_error:
        enforce(checked)
    return checked


def run_quality(spark: SparkSession, lake: LakeConfig, as_of: str | None = None) -> DataFrame:
    """Check the silver tables (their age as of the given moment or now), keep the results as a table and stop the run if the gate is closed."""
    silver = {table: read_layer(spark, lake.path("silver", table)) for table in SILVER_TABLES}
    limits = lake.limits
    results = (
        check_customers(silver["customers"], limits, as_of)
        .unionByName(check_products(silver["products"], limits, as_of))
        .unionByName(check_orders(silver["orders"], silver["customers"], limits, as_of))
        .unionByName(check_order_items(silver["order_items"], silver["orders"], silver["products"], limits, as_of))
    )
    path = lake.path("quality", "silver_checks")
    replace_table(results, path)
    written = read_layer(spark, path)
    if limits.fail_on_error:
        enforce(written)
    return written


def run_gold(
    spark: SparkSession, lake: LakeConfig, as_of: str | None = None, effective: str | None = None
) -> dict[str, WriteReport]:
    """Build dimensions, then facts from the written dimensions, then the aggregates.

    With ``effective`` the changes of that day go into the Type 2 histories
    first. Dimensions then keep the keys of the histories from run to run, and
    the fact takes the versions that were valid when an order was placed.
    Otherwise keys follow the order of the natural keys and the fact takes the
    current state. Shuffles are sized by the silver files.
    """
    missing = [t for t in SILVER_TABLES if not path_exists(spark, lake.path("silver", t))]
    if missing:
        raise FileNotFoundError(f"silver tables missing: {', '.join(missing)}")
    silver = {table: read_layer(spark, lake.path("silver", table)) for table in SILVER_TABLES}
    with shuffle_sizing(spark, list(silver.values())):
        return _gold_tables(spark, lake, silver, as_of, effective)


def _gold_tables(spark, lake, silver, as_of, effective) -> dict[str, WriteReport]:
    reports = {}

    def save(name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
        with scratch_scope(spark):
            reports[name] = replace_table(build(), lake.path("gold", name), partition_by=partition_by)
        return read_layer(spark, lake.path("gold", name))

    def versioned(name: str, profiles: DataFrame) -> DataFrame:
        natural, key = dimensions.NATURAL_KEYS[name], dimensions.SURROGATE_KEYS[name]
        history = save(f"{name}_history", lambda: _next_history(spark, lake, name, profiles, effective))
        save(name, lambda: dimensions.with_stable_keys(profiles, history, key, natural))
        return history

    days = dimensions.calendar(spark, lake.calendar_start_year, lake.calendar_end_year)
    save("dim_date", lambda: dimensions.dim_date(days))
    if effective:
        products = versioned("dim_product", dimensions.product_profiles(silver["products"]))
        customers = versioned(
            "dim_customer", dimensions.customer_profiles(silver["customers"], silver["orders"], as_of))
    else:
        products = save("dim_product", lambda: dimensions.dim_product(silver["products"]))
        customers = save(
            "dim_customer", lambda: dimensions.dim_customer(silver["customers"], silver["orders"], as_of))
    fact = save(
        "fact_sales",
        lambda: facts.fact_sales(silver["order_items"], silver["orders"], customers, products, bool(effective),
                                 lake.hot_order_share),
        partition_by=GOLD_PARTITIONS["fact_sales"],
    )
    save("agg_daily_sales", lambda: marts.daily_sales(fact))
    save("agg_product_performance", lambda: marts.product_performance(fact, products))
    return reports


def run_marts(spark: SparkSession, lake: LakeConfig, k: int = 10) -> dict[str, WriteReport]:
    """Weekly, monthly, category, customer and best-seller figures as gold tables, from the written fact and dimensions."""
    needed = ("fact_sales", "dim_product", "dim_date")
    missing = [name for name in needed if not path_exists(spark, lake.path("gold", name))]
    if not path_exists(spark, lake.path("silver", "orders")):
        missing.append("silver orders")
    if missing:
        raise FileNotFoundError(f"tables missing: {', '.join(missing)}")
    fact, products, days = (read_layer(spark, lake.path("gold", name)) for name in needed)
    builders = {
        "agg_weekly_sales": lambda: marts.sales_by_period(fact, "week"),
        "agg_monthly_sales": lambda: marts.sales_by_period(fact, "month"),
        "agg_category_performance": lambda: marts.category_performance(fact, products, days),
        "agg_daily_revenue": lambda: marts.daily_revenue(fact),
        "agg_orders_per_customer": lambda: marts.orders_per_customer(fact),
        "agg_customer_lifetime_value": lambda: marts.customer_lifetime_value(read_layer(spark, lake.path("silver", "orders"))),
        "top_products": lambda: marts.top_products(fact, products, k),
        "best_sellers": lambda: marts.best_sellers(fact, products, k),
    }
    reports = {}
    with shuffle_sizing(spark, [fact]):
        for name in MART_TABLES:
            with scratch_scope(spark):
                reports[name] = replace_table(builders[name](), lake.path("gold", name))
    return reports


def _next_history(spark, lake, name, profiles, effective) -> DataFrame:
    """The history after today's profiles; the first one has an open version of every member."""
    natural, key, tracked = dimensions.NATURAL_KEYS[name], dimensions.SURROGATE_KEYS[name], dimensions.TRACKED_ATTRIBUTES[name]
    target = lake.path("gold", f"{name}_history")
    if path_exists(spark, target):
        return merge_history(read_layer(spark, target), profiles, natural, key, tracked, effective)
    keyed = profiles if key in profiles.columns else number_rows(profiles, key, [natural])
    return dimensions.start_history(keyed, key, natural, tracked)


def run_history(spark: SparkSession, lake: LakeConfig, effective: str) -> dict[str, WriteReport]:
    """Carry the changes of the gold dimensions into their Type 2 histories.

    The first call starts a history from the dimension; later calls close the
    versions that changed by ``effective`` and open new ones.
    """
    reports = {}
    for name in dimensions.TRACKED_ATTRIBUTES:
        latest = read_layer(spark, lake.path("gold", name))
        with scratch_scope(spark):
            history = _next_history(spark, lake, name, latest, effective)
            reports[name] = replace_table(history, lake.path("gold", f"{name}_history"))
    return reports


def run_cleanup(spark: SparkSession, lake: LakeConfig, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions of every table; returns how many folders went."""
    tables = [("silver", t) for t in SILVER_TABLES] + [("gold", t) for t in GOLD_PARTITIONS]
    tables += [("gold", t) for t in MART_TABLES]
    tables += [("gold", f"{name}_history") for name in dimensions.TRACKED_ATTRIBUTES] + [("quality", "silver_checks")]
    return sum(remove_old_versions(spark, lake.path(layer, table), keep) for layer, table in tables)


def check_load(spark: SparkSession, lake: LakeConfig) -> tuple[DataFrame, DataFrame]:
    """After a load: null and orphan keys per dimension, and the business totals."""
    gold = {name: read_layer(spark, lake.path("gold", name)) for name in ("fact_sales", "dim_customer", "dim_product")}
    keys = facts.orphan_keys(
        gold["fact_sales"],
        [(gold["dim_customer"], "customer_key"), (gold["dim_product"], "product_key")],
    )
    return keys, marts.business_totals(gold["fact_sales"])


def register_layers(spark: SparkSession, lake: LakeConfig, database: str) -> list[str]:
    """Make the silver and gold tables, and the marts that were built, known to the catalog; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    layers = [("silver", table, ()) for table in SILVER_TABLES]
    layers += [("gold", table, partition_by) for table, partition_by in GOLD_PARTITIONS.items()]
    layers += [("gold", table, ()) for table in MART_TABLES if path_exists(spark, lake.path("gold", table))]
    for layer, table, partition_by in layers:
        register_table(spark, f"{database}.{table}", lake.path(layer, table), partition_by)
    return [f"{database}.{table}" for _, table, _ in layers]


def run_all(
    spark: SparkSession,
    lake: LakeConfig,
    as_of: str | None = None,
    file_format: str = "csv",
    incremental: bool = False,
    with_marts: bool = False,
) -> dict:
    """All layers in order; the figures of ``run_marts`` on demand."""
    bronze = run_bronze(spark, lake, file_format=file_format, incremental=incremental)
    if lake.gate_keys:
        run_key_gate(spark, lake)
    silver = run_silver(spark, lake, as_of=as_of)
    run_quality(spark, lake, as_of)
    done = {"bronze": bronze, "silver": silver, "gold": run_gold(spark, lake, as_of)}
    return {**done, "marts": run_marts(spark, lake)} if with_marts else done
