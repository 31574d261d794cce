"""Customer cohorts: direct sales, large companies, invoice and receipt customers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clientela.config import DIRECT_SALES_AREA, INVOICE, RECEIPT, TYPE_B, RunConfig
from clientela.functions.ranking import sample_rows, sample_share
from clientela.functions.selection import above_tiles, tile_bounds, tile_of
from clientela.functions.storage import materialise
from clientela.operators.features import measure_tasks
from clientela.operators.lines import (
    SALE_TYPES,
    beside_lines,
    in_scope,
    is_positive,
    item_keys,
    join_catalog,
    period_window,
    valid_sales,
    with_customer,
    with_item_key,
    with_transaction,
)
from clientela.operators.measures import count_transactions
from clientela.sources.tables import Sources


@dataclass(frozen=True)
class Cohorts:
    """The customer sets of a run. ``invoice`` and ``receipt`` are disjoint."""

    direct: DataFrame
    large: DataFrame
    invoice: DataFrame
    receipt: DataFrame


def sold_keys(src: Sources, cfg: RunConfig) -> DataFrame:
    """Keys of the catalog to filter sale lines by; written where the lines ask for more tasks."""
    keys, tasks = item_keys(src.items, cfg), measure_tasks(src)
    return keys if tasks is None else beside_lines(materialise(keys, "item_keys"), tasks)


def customer_flags(src: Sources, cfg: RunConfig) -> DataFrame:
    """What each customer has bought, in one scan: a flag per cohort condition.

    All cohorts ask whether a sale of some kind exists, so the catalog is only a
    filter (semi join) and the flags are pre-aggregated before the shuffle.
    """
    start, end = period_window(cfg.period, cfg.months)
    day = F.col("sales_return_dt")
    history = day >= F.lit(cfg.history_from).cast("date")
    window = day >= F.lit(start)
    kind = F.col("sales_return_type_cd")
    sold = (
        in_scope(src.sales, cfg)
        .filter((history | window) & (day < F.lit(end)) & kind.isin(*SALE_TYPES))
        .transform(with_item_key)
        .join(sold_keys(src, cfg), "item_key", "left_semi")
    )
    return (
        with_customer(sold)
        .groupBy("customer_id")
        .agg(
            F.bool_or(history & (F.col("business_area_sales_flg") == DIRECT_SALES_AREA)).alias(
                "direct"
            ),
            F.bool_or(history & is_positive()).alias("bought"),
            F.bool_or(history & is_positive() & (kind == INVOICE)).alias("invoice"),
            F.bool_or(window & is_positive() & (kind == RECEIPT)).alias("receipt"),
        )
    )


def cohort_state(lines: DataFrame, src: Sources, cfg: RunConfig) -> DataFrame:
    """What some sale lines say about their customers, whatever the window they are read for.

    The history conditions are flags that never go back; of receipts the last day is kept,
    so that the window can move. Lines may come in any order and more than once: a state is
    the same after lines that it has seen.
    """
    kind = F.col("sales_return_type_cd")
    history = F.col("sales_return_dt") >= F.lit(cfg.history_from).cast("date")
    sold = (
        in_scope(lines, cfg)
        .filter(history & kind.isin(*SALE_TYPES))
        .transform(with_item_key)
        .join(sold_keys(src, cfg), "item_key", "left_semi")
    )
    receipt = F.when(is_positive() & (kind == RECEIPT), F.col("sales_return_dt"))
    return (
        with_customer(sold)
        .groupBy("customer_id")
        .agg(
            F.bool_or(F.col("business_area_sales_flg") == DIRECT_SALES_AREA).alias("direct"),
            F.bool_or(is_positive()).alias("bought"),
            F.bool_or(is_positive() & (kind == INVOICE)).alias("invoice"),
            F.max(receipt).alias("last_receipt"),
        )
    )


def merge_states(state: DataFrame, more: DataFrame) -> DataFrame:
    """The state after more lines: one shuffle of customers, none of the lines seen before."""
    return (
        state.unionByName(more)
        .groupBy("customer_id")
        .agg(
            *[F.bool_or(flag).alias(flag) for flag in ("direct", "bought", "invoice")],
            F.max("last_receipt").alias("last_receipt"),
        )
    )


def flags_of_state(state: DataFrame, cfg: RunConfig) -> DataFrame:
    """``customer_flags`` of a run, from a state that has seen all lines before the run's end.

    The window must lie inside the history, and no line after the end may have been merged.
    """
    start, end = period_window(cfg.period, cfg.months)
    if str(start) < cfg.history_from:
        raise ValueError(f"the window starts at {start}, before the history at {cfg.history_from}")
    late = F.concat(F.lit("the state has seen receipts of "), F.col("last_receipt").cast("string"))
    last = F.when(F.col("last_receipt") >= F.lit(end), F.raise_error(late).cast("date")).otherwise(
        F.col("last_receipt")
    )
    recent = F.coalesce(last >= F.lit(start), F.lit(False))
    return state.select("customer_id", "direct", "bought", "invoice", recent.alias("receipt"))


def in_country(df: DataFrame, cfg: RunConfig) -> DataFrame:
    return df.filter(F.col("country_id") == cfg.country)


def without_excluded(customers: DataFrame, exclusions: DataFrame, cfg: RunConfig) -> DataFrame:
    listed = in_country(exclusions, cfg).select(F.trim("customer_id").alias("customer_id"))
    return customers.join(listed, "customer_id", "left_anti")


def below_tranche(customers: DataFrame, register: DataFrame, cfg: RunConfig) -> DataFrame:
    """Keep customers that are not registered, or have one tranche below the limit."""
    lowest = (
        in_country(register, cfg)
        .groupBy(F.trim("customer_id").alias("customer_id"))
        .agg(F.min("tramo_ventas").alias("lowest_tranche"), F.lit(True).alias("registered"))
    )
    return (
        customers.join(lowest, "customer_id", "left")
        .filter(F.col("registered").isNull() | (F.col("lowest_tranche") < cfg.ggee_tranche))
        .drop("registered", "lowest_tranche")
    )


def not_in_set(flag: Column) -> Column:
    """Not a member of a set. A missing id never equals one, so it is in no set."""
    return F.col("customer_id").isNull() | ~flag


def admitted(flags: DataFrame, src: Sources, cfg: RunConfig) -> DataFrame:
    """Customers neither excluded nor registered at or above the limit."""
    return below_tranche(without_excluded(flags, src.exclusions, cfg), src.sii_data, cfg)


def direct_customers(allowed: DataFrame) -> DataFrame:
    return allowed.filter("direct").select("customer_id")


def large_customers(flags: DataFrame, src: Sources, cfg: RunConfig) -> DataFrame:
    """Customers with a sale and a register entry, one row per tranche."""
    register = in_country(src.sii_data, cfg).select(
        F.trim("customer_id").alias("customer_id"), F.col("tramo_ventas").alias("sales_tranche")
    )
    bought = without_excluded(flags.filter("bought").select("customer_id"), src.exclusions, cfg)
    return bought.join(register.distinct(), "customer_id")


def invoice_customers(allowed: DataFrame) -> DataFrame:
    """Derived cohort: an invoice in the history, and no direct sale."""
    return allowed.filter(F.col("invoice") & not_in_set(F.col("direct"))).select("customer_id")


def listed_invoice_customers(direct: DataFrame, src: Sources, cfg: RunConfig) -> DataFrame:
    """Given cohort: the company list minus exclusions, direct sales and high tranches.

    List rows are kept as they are: not distinct, ids not trimmed, one row for each
    register entry below the limit.
    """
    listed = in_country(src.companies, cfg).select("customer_id", F.trim("customer_id").alias("id"))
    excluded = in_country(src.exclusions, cfg).select(F.trim("customer_id").alias("id"))
    register = in_country(src.sii_data, cfg).select(
        F.trim("customer_id").alias("id"), "tramo_ventas", F.lit(True).alias("registered")
    )
    return (
        listed.join(excluded, "id", "left_anti")
        .join(direct.withColumnRenamed("customer_id", "id"), "id", "left_anti")
        .join(register, "id", "left")
        .filter(F.col("registered").isNull() | (F.col("tramo_ventas") < cfg.ggee_tranche))
        .select("customer_id")
    )


def receipt_customers(allowed: DataFrame, listed_invoice: DataFrame | None = None) -> DataFrame:
    """A receipt in the window, and member of neither of the two cohorts above."""
    candidates = allowed.filter(F.col("receipt") & not_in_set(F.col("direct")))
    if listed_invoice is None:
        return candidates.filter(not_in_set(F.col("invoice"))).select("customer_id")
    return candidates.select("customer_id").join(listed_invoice, "customer_id", "left_anti")


def build_cohorts(src: Sources, cfg: RunConfig, flags: DataFrame | None = None) -> Cohorts:
    flags = customer_flags(src, cfg) if flags is None else flags
    allowed = admitted(flags, src, cfg)
    direct = direct_customers(allowed)
    listed = None if src.companies is None else listed_invoice_customers(direct, src, cfg)
    return Cohorts(
        direct=direct,
        large=large_customers(flags, src, cfg),
        invoice=invoice_customers(allowed) if listed is None else listed,
        receipt=receipt_customers(allowed, listed),
    )


def all_customers(cohorts: Cohorts) -> DataFrame:
    """Invoice customers as target 1, receipt customers as target 0."""
    one = cohorts.invoice.withColumn("target", F.lit(1))
    return one.unionByName(cohorts.receipt.withColumn("target", F.lit(0)))


def feature_customers(cohorts: Cohorts) -> DataFrame:
    """The distinct customers features are computed for."""
    return (
        cohorts.invoice.union(cohorts.receipt)
        .union(cohorts.direct)
        .union(cohorts.large.select("customer_id"))
        .distinct()
    )


def feature_customers_of_flags(flags: DataFrame, src: Sources, cfg: RunConfig) -> DataFrame:
    """The same set in one pass over the flags, for the derived invoice cohort.

    A customer of the receipt or invoice cohort is admitted and has the flag, whatever
    its other cohorts; a large one has a sale and a register entry.
    """
    register = (
        in_country(src.sii_data, cfg)
        .groupBy(F.trim("customer_id").alias("customer_id"))
        .agg(F.min("tramo_ventas").alias("lowest_tranche"), F.lit(True).alias("registered"))
    )
    free = F.col("registered").isNull() | (F.col("lowest_tranche") < cfg.ggee_tranche)
    in_cohort = F.col("direct") | F.col("invoice") | F.col("receipt")
    return (
        without_excluded(flags, src.exclusions, cfg)
        .join(register, "customer_id", "left")
        .filter((free & in_cohort) | (F.col("registered").isNotNull() & F.col("bought")))
        .select("customer_id")
    )


def invoice_totals(cohorts: Cohorts, src: Sources, cfg: RunConfig) -> DataFrame:
    """Transactions, sales and units of invoice customers, in all and on invoices alone."""
    lines = join_catalog(valid_sales(src.sales, cfg), item_keys(src.items, cfg))
    per_type = count_transactions(
        with_customer(with_transaction(lines, cfg)), ["customer_id", "sales_return_type_cd"]
    )
    # A customer listed several times counts its sums as often, its transactions once.
    listed = cohorts.invoice.groupBy("customer_id").agg(F.count(F.lit(1)).alias("times"))
    on_invoice = F.col("sales_return_type_cd") == INVOICE
    money = "decimal(38,9)"

    def invoiced(value: str) -> Column:
        none = F.lit(0).cast(per_type.schema[value].dataType)
        return F.max(F.when(on_invoice, F.col(value)).otherwise(none))

    totals = per_type.groupBy("customer_id").agg(
        F.sum("transactions").alias("total_transactions"),
        invoiced("transactions").alias("total_transactions_fctr"),
        F.sum("amount").alias("sales_amt"),
        invoiced("amount").alias("sales_amt_fctr"),
        F.sum("units").alias("units_cnt"),
        invoiced("units").alias("units_cnt_fctr"),
    )
    members = totals.join(listed, "customer_id").join(cohorts.direct, "customer_id", "left_anti")
    if cfg.country != cfg.country_without_pro_filter:
        members = members.filter(F.col("sales_amt_fctr") > 0)
    times = F.col("times")
    return members.select(
        "customer_id",
        "total_transactions",
        "total_transactions_fctr",
        (F.col("sales_amt") * times).cast(money).alias("total_sales_amt"),
        (F.col("sales_amt_fctr") * times).cast(money).alias("total_sales_amt_fctr"),
        (F.col("units_cnt") * times).cast(money).alias("total_units_cnt"),
        (F.col("units_cnt_fctr") * times).cast(money).alias("total_units_cnt_fctr"),
    )


TILES = 100
INVOICE_SHARES = {
    "transactions_tile": ("total_transactions_fctr", "total_transactions"),
    "sales_tile": ("total_sales_amt_fctr", "total_sales_amt"),
    "units_tile": ("total_units_cnt_fctr", "total_units_cnt"),
}


def _with_shares(totals: DataFrame) -> DataFrame:
    """Customers that have sales, with their invoice shares as doubles, as a written table."""
    some = totals.filter(
        (F.col("total_transactions") != 0)
        & (F.col("total_sales_amt") != 0)
        & (F.col("total_units_cnt") != 0)
    )
    shares = {
        f"{tile}_share": F.col(part).cast("double") / F.col(whole).cast("double")
        for tile, (part, whole) in INVOICE_SHARES.items()
    }
    return materialise(some.withColumns(shares), "invoice_shares")


def with_invoice_tiles(totals: DataFrame) -> DataFrame:
    """Percentile of each customer in the invoice share of transactions, sales and units.

    The ends of all percentiles come from counts; no row is sorted or moved.
    """
    shared = _with_shares(totals)
    names = [f"{tile}_share" for tile in INVOICE_SHARES]
    bounds = tile_bounds(shared, names, "customer_id", shared.count(), TILES)
    tiles = {
        tile: tile_of(F.col(f"{tile}_share"), F.col("customer_id"), bounds[f"{tile}_share"])
        for tile in INVOICE_SHARES
    }
    return shared.withColumns(tiles).select(*totals.columns, *INVOICE_SHARES)


def pro_customers(totals: DataFrame, cfg: RunConfig) -> DataFrame:
    """Invoice customers above the lowest percentiles of all three invoice shares."""
    if cfg.country == cfg.country_without_pro_filter:
        return totals.filter(
            (F.col("total_transactions") != 0)
            & (F.col("total_sales_amt") != 0)
            & (F.col("total_units_cnt") != 0)
        )
    shared = _with_shares(totals)
    names = [f"{tile}_share" for tile in INVOICE_SHARES]
    above = above_tiles(shared, names, "customer_id", shared.count(), TILES, cfg.percentile)
    return above.select(*totals.columns)


def cohort_counts(pro: DataFrame, totals: DataFrame) -> DataFrame:
    """Size of the professional set and of the set it was taken from."""

    def size(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count_distinct("customer_id").alias("customers")).select(
            F.lit(label).alias("cohort"), "customers"
        )

    return size(totals, "TOTAL_FCTR").union(size(pro, "TOTAL_PRO")).orderBy("cohort")


def home_sample(receipt: DataFrame, pro: DataFrame, cfg: RunConfig) -> DataFrame:
    """``n_times`` receipt customers for each professional one, exactly."""
    wanted = pro.agg(F.count_distinct("customer_id")).first()[0] * cfg.n_times
    return sample_rows(receipt, "customer_id", wanted, cfg.seed)


def training_customers(pro: DataFrame, home: DataFrame, cfg: RunConfig) -> DataFrame:
    """A share of each class with its target."""

    def drawn(df: DataFrame, target: int) -> DataFrame:
        ids = df.select("customer_id")
        if cfg.sample < 1.0:
            ids = sample_share(ids, "customer_id", cfg.sample, cfg.seed)
        return ids.withColumn("target", F.lit(target))

    return drawn(pro, 1).unionByName(drawn(home, 0))


def profile_subset(results: DataFrame, profile: str = TYPE_B) -> DataFrame:
    return results.filter(F.col("company_profile") == profile).select("customer_id")


def final_results(profile: DataFrame, need: DataFrame) -> DataFrame:
    """One table of profile, segment and recency, a row for each profile row."""
    segments = need.select(
        "customer_id",
        F.col("necessity_lvl_2").alias("company_necessity"),
        F.col("necessity_lvl_2_recency").alias("company_recency_status"),
    )
    return profile.join(segments, "customer_id", "left").select(
        "country_id",
        "customer_id",
        "company_profile",
        "company_necessity",
        "company_recency_status",
    )
