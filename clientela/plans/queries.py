"""Every operator as a query over a folder of TPC-H style tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from clientela.config import RunConfig
from clientela.functions import columns as fc
from clientela.functions.storage import materialise, scratch_path
from clientela.functions.vectors import stored, width_of
from clientela.operators import cohorts as co
from clientela.operators import datasets as ds
from clientela.operators import features as fe
from clientela.operators import featureset as fs
from clientela.operators import lines as li
from clientela.operators import measures as me
from clientela.operators import models as mo
from clientela.operators import rules as ru
from clientela.operators.clusters import certificate
from clientela.operators.surrogate import fit_surrogate_tree
from clientela.plans import monthly as mp
from clientela.sources import sinks
from clientela.sources.tables import Sources
from clientela.sources.tpch import TPCH_RUN, tpch_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AT = "2001-01-02 03:04:05"
CFG = TPCH_RUN
# Stand-in for tree splits, so that another engine can follow the rules.
THRESHOLDS = ru.NeedThresholds(
    total_sales_amt=600000.0, per_trx_frec_N0=0.6, months_since_last_trx=6.0
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Shared steps ------------------------------------------------------------------------


def _cohorts(src: Sources, cfg: RunConfig = CFG) -> co.Cohorts:
    """Cohorts from flags that are written once, however many cohorts are read."""
    return co.build_cohorts(src, cfg, materialise(co.customer_flags(src, cfg), "flags"))


def _universe(src: Sources) -> DataFrame:
    return co.feature_customers_of_flags(co.customer_flags(src, CFG), src, CFG)


def _features(spark: SparkSession, folder: str, *families: str) -> DataFrame:
    src = tpch_sources(spark, folder)
    return fe.features(src, CFG, _universe(src), families or fe.FAMILIES)


def _base(spark: SparkSession, folder: str, *families: str) -> tuple[Sources, mp.Base]:
    """Written features (of all families by default) with cohorts and customers."""
    src = tpch_sources(spark, folder)
    if not families:
        return src, mp.build_base(src, CFG)
    flags = materialise(co.customer_flags(src, CFG), "flags")
    universe = co.feature_customers_of_flags(flags, src, CFG)
    features = materialise(fe.features(src, CFG, universe, families), "features")
    cohorts = co.build_cohorts(src, CFG, flags)
    return src, mp.Base(cohorts, co.all_customers(cohorts), features)


def _stand_in_scores(base: mp.Base) -> DataFrame:
    """Scores by a hash of the customer, so that another engine can follow the rules."""
    digits = F.substring(fc.stable_hash(F.col("customer_id"), CFG.seed, "score"), 1, 8)
    with_sales = base.features.filter(F.col("feature_name") == "total_transactions")
    known = base.customers.join(with_sales.select("customer_id"), "customer_id", "left_semi")
    indexed = ds.customer_dictionary(known)
    drawn = F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)
    return mo.with_prediction(
        known.join(indexed, "customer_id").withColumn("prob_typeB", drawn), CFG
    )


def _profile(src: Sources, base: mp.Base, upto: str = ru.RULES[-1]) -> DataFrame:
    return ru.apply_profile_rules(_stand_in_scores(base), base.cohorts, src, CFG, AT, upto)


NEED_FAMILIES = ("from_totals", "top_share")


def _needs(spark: SparkSession, folder: str) -> tuple[mp.Base, DataFrame]:
    src, base = _base(spark, folder, *NEED_FAMILIES)
    return base, materialise(_profile(src, base), "profile")


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# Sources and sinks ---------------------------------------------------------------------


@query
def scan_sources(spark: SparkSession, folder: str) -> DataFrame:
    counts = [
        table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, table in tpch_sources(spark, folder, with_companies=True).named().items()
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


@query
def period_window(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("sales_return_dt")
    periods = (
        tpch_sources(spark, folder)
        .sales.select((F.year(day) * 100 + F.month(day)).cast("long").alias("period"))
        .distinct()
    )
    period = F.col("period")
    return periods.select(
        "period",
        fc.period_start(period, CFG.months).cast("string").alias("date_from"),
        fc.period_end(period).cast("string").alias("date_to"),
        fc.period_last_day(period).cast("string").alias("date_to_inclusive"),
    )


@query
def publish_results(spark: SparkSession, folder: str) -> DataFrame:
    customers = co.all_customers(_cohorts(tpch_sources(spark, folder)))
    return sinks.publish_parquet(customers, scratch_path(spark, "published"))


@query
def csv_gzip_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "export")
    sinks.export_csv(_features(spark, folder, "from_totals"), path)
    return sinks.read_csv_folder(spark, path, fe.FEATURE_SCHEMA, ".csv.gz")


@query
def publish_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A run put into its partition twice, and another one next to it: one copy of each."""
    customers = co.all_customers(_cohorts(tpch_sources(spark, folder)))
    path = scratch_path(spark, "partitioned")
    placed = materialise(customers.withColumn("period", F.lit(CFG.period)), "run")
    sinks.put_partitions(placed, path, "period")
    sinks.put_partitions(placed.withColumn("period", F.lit(CFG.period + 1)), path, "period")
    return sinks.put_partitions(placed, path, "period").select("customer_id", "target", "period")


@query
def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Every fiftieth document number is damaged on the way out; its lines are kept apart."""
    sales = tpch_sources(spark, folder).sales
    number = F.col("sales_return_document_num")
    damaged = F.when(number % 50 == 0, F.concat(F.lit("?"), number)).otherwise(number.cast("string"))
    path = scratch_path(spark, "damaged")
    sinks.export_csv(sales.select(damaged.alias("number"), F.trim("item_id").alias("item")), path)
    rows, apart = sinks.read_csv_checked(
        spark, path, "number long, item string", scratch_path(spark, "quarantine"), ".csv.gz"
    )
    return rows.select(F.col("number").cast("string"), "item", F.lit(None).cast("string").alias("line")).unionByName(
        apart.select(F.lit(None).cast("string").alias("number"), F.lit(None).cast("string").alias("item"), "line")
    )


# Projections, filters, joins -----------------------------------------------------------


@query
def canonical_customer(spark: SparkSession, folder: str) -> DataFrame:
    sales = tpch_sources(spark, folder).sales
    raw = sales.withColumn("raw_customer_id", F.col("customer_id"))
    return (
        li.with_customer(raw)
        .groupBy("customer_id", "raw_customer_id", "main_customer_id")
        .agg(F.count(F.lit(1)).alias("sale_lines"))
    )


@query
def valid_sales(spark: SparkSession, folder: str) -> DataFrame:
    sales = li.with_customer(li.valid_sales(tpch_sources(spark, folder).sales, CFG))
    return sales.select(
        "customer_id",
        "item_id",
        F.col("sales_return_dt").cast("string").alias("sales_return_dt"),
        "sales_return_type_cd",
        "sales_return_document_num",
        "location_id",
        F.col("st_extended_net_amt").cast("double").alias("st_extended_net_amt"),
        F.col("unit_cnt").cast("double").alias("unit_cnt"),
    )


@query
def safe_item_key(spark: SparkSession, folder: str) -> DataFrame:
    per_text = tpch_sources(spark, folder).sales.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("sale_lines")
    )
    return li.with_item_key(per_text)


@query
def months_since_last(spark: SparkSession, folder: str) -> DataFrame:
    end = F.lit(li.period_window(CFG.period, CFG.months)[1])
    sales = tpch_sources(spark, folder).sales.filter(F.col("sales_return_dt") < end)
    last = li.with_customer(sales).groupBy("customer_id").agg(F.max("sales_return_dt").alias("last"))
    months = fc.months_between_calendar(end, F.col("last")).cast("long")
    return last.select("customer_id", months.alias("months_since_last_trx"))


@query
def join_sales_items(spark: SparkSession, folder: str) -> DataFrame:
    src = tpch_sources(spark, folder)
    return li.with_customer(li.join_sales_items(src.sales, src.items, CFG)).select(
        "customer_id",
        "sales_return_document_num",
        "item_id",
        "catalog_item_id",
        "hier_family_cd",
        "hier_subfamily_cd",
    )


def _customers_in_sales(src: Sources) -> DataFrame:
    return li.with_customer(src.sales).select("customer_id").distinct()


@query
def join_exclusions_anti(spark: SparkSession, folder: str) -> DataFrame:
    src = tpch_sources(spark, folder)
    return co.without_excluded(_customers_in_sales(src), src.exclusions, CFG)


@query
def join_tranche_tristate(spark: SparkSession, folder: str) -> DataFrame:
    src = tpch_sources(spark, folder)
    return co.below_tranche(_customers_in_sales(src), src.sii_data, CFG)


@query
def join_scalar_subquery(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder, "from_totals")
    members = base.features.filter(F.col("feature_name") == CFG.outliers.feature).join(
        base.customers.select("customer_id"), "customer_id"
    )
    fence = fs.outlier_fence(base.features, base.customers, CFG.outliers, exact=True)
    return fs.below_fence(members, fence).select("customer_id", "feature_value")


@query
def distinct_transactions(spark: SparkSession, folder: str) -> DataFrame:
    sales = li.with_customer(li.with_transaction(tpch_sources(spark, folder).sales, CFG))
    counted = me.count_transactions(sales, ["customer_id", "sales_return_type_cd"])
    return _doubles(counted.drop("last_day"), "units", "amount")


# Cohorts -------------------------------------------------------------------------------


@query
def cohort_ve(spark: SparkSession, folder: str) -> DataFrame:
    return co.build_cohorts(tpch_sources(spark, folder), CFG).direct


@query
def cohort_ggee(spark: SparkSession, folder: str) -> DataFrame:
    return co.build_cohorts(tpch_sources(spark, folder), CFG).large


@query
def cohort_fctr(spark: SparkSession, folder: str) -> DataFrame:
    return co.build_cohorts(tpch_sources(spark, folder), CFG).invoice


@query
def cohort_fctr_list(spark: SparkSession, folder: str) -> DataFrame:
    return co.build_cohorts(tpch_sources(spark, folder, with_companies=True), CFG).invoice


@query
def cohort_blta(spark: SparkSession, folder: str) -> DataFrame:
    return co.build_cohorts(tpch_sources(spark, folder), CFG).receipt


@query
def all_customers(spark: SparkSession, folder: str) -> DataFrame:
    return co.all_customers(_cohorts(tpch_sources(spark, folder)))


@query
def all_customers_ve(spark: SparkSession, folder: str) -> DataFrame:
    return co.feature_customers(_cohorts(tpch_sources(spark, folder)))


@query
def cohort_state_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Flags from a running state: old lines, then those of the last months, then late ones."""
    src = tpch_sources(spark, folder)
    start, end = li.period_window(CFG.period, 6)
    day = F.col("sales_return_dt")
    late = F.col("sales_return_document_num") % 10 == 0
    steps = [
        (day < F.lit(start)) & ~late,
        (day >= F.lit(start)) & (day < F.lit(end)) & ~late,
        (day < F.lit(end)) & late,
    ]
    path = scratch_path(spark, "cohort_state")
    for step in steps:
        state = co.cohort_state(src.sales.filter(step), src, CFG)
        if step is not steps[0]:
            state = co.merge_states(sinks.read_published(spark, path), state)
        sinks.publish_parquet(state, path)
    return co.flags_of_state(sinks.read_published(spark, path), CFG)


def _invoice_totals(spark: SparkSession, folder: str) -> tuple[Sources, co.Cohorts, DataFrame]:
    src = tpch_sources(spark, folder)
    cohorts = _cohorts(src)
    return src, cohorts, co.invoice_totals(cohorts, src, CFG)


@query
def fctr_data(spark: SparkSession, folder: str) -> DataFrame:
    totals = _invoice_totals(spark, folder)[2]
    return _doubles(
        totals,
        "total_sales_amt",
        "total_sales_amt_fctr",
        "total_units_cnt",
        "total_units_cnt_fctr",
    )


@query
def ntile_filter(spark: SparkSession, folder: str) -> DataFrame:
    tiled = co.with_invoice_tiles(_invoice_totals(spark, folder)[2])
    return tiled.select("customer_id", *co.INVOICE_SHARES)


@query
def pro_customers(spark: SparkSession, folder: str) -> DataFrame:
    pro = co.pro_customers(_invoice_totals(spark, folder)[2], CFG)
    kept = pro.select("customer_id", "total_transactions", "total_sales_amt", "total_units_cnt")
    return _doubles(kept, "total_sales_amt", "total_units_cnt")


@query
def cohort_counts(spark: SparkSession, folder: str) -> DataFrame:
    totals = materialise(_invoice_totals(spark, folder)[2], "invoice_totals")
    return co.cohort_counts(co.pro_customers(totals, CFG), totals)


def _pro_and_home(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    _, cohorts, totals = _invoice_totals(spark, folder)
    pro = materialise(co.pro_customers(totals, CFG), "pro")
    return pro, co.home_sample(cohorts.receipt, pro, CFG)


@query
def sample_exact_n(spark: SparkSession, folder: str) -> DataFrame:
    return _pro_and_home(spark, folder)[1]


@query
def sample_fraction(spark: SparkSession, folder: str) -> DataFrame:
    pro, home = _pro_and_home(spark, folder)
    return co.training_customers(pro, home, replace(CFG, sample=0.4))


@query
def profile_subset(spark: SparkSession, folder: str) -> DataFrame:
    src, base = _base(spark, folder, *NEED_FAMILIES)
    return co.profile_subset(_profile(src, base))


# Features --------------------------------------------------------------------------------


@query
def totals(spark: SparkSession, folder: str) -> DataFrame:
    src = tpch_sources(spark, folder)
    return fe.totals(src, CFG, _universe(src))


def _register_families() -> None:
    for family in fe.FAMILIES:

        def run(spark: SparkSession, folder: str, family: str = family) -> DataFrame:
            return _features(spark, folder, family)

        QUERIES[f"feat_{family}"] = run


_register_families()


@query
def feat_label_share(spark: SparkSession, folder: str) -> DataFrame:
    src = tpch_sources(spark, folder)
    label = F.concat(
        F.lit("per_trx_type_"),
        F.col("sales_return_type_cd"),
        F.lit("_"),
        F.trim("hier_department_cd"),
    )
    return fe.label_share(src, CFG, _universe(src), label)


@query
def top_share(spark: SparkSession, folder: str) -> DataFrame:
    shares = _features(spark, folder, "per_trx_hier")
    return fe.top_value(shares, "per_trx_N0_%", "top_N0")


@query
def all_features(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder)


@query
def all_features_merged(spark: SparkSession, folder: str) -> DataFrame:
    """From a store of months: last month's run left its window, this one adds its last month."""
    src = tpch_sources(spark, folder)
    store = scratch_path(spark, "months")
    year, month = divmod(CFG.period, 100)
    before = (year - 1) * 100 + 12 if month == 1 else CFG.period - 1
    fe.put_months(src, replace(CFG, period=before), store)
    fe.put_months(src, replace(CFG, months=1), store)
    return fe.features_of_months(src, CFG, store, _universe(src))


# Feature sets ------------------------------------------------------------------------------


@query
def feature_select(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder)
    return fs.select_features(base.features, base.customers, CFG.profile_set.features)


@query
def std_fit(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder)
    fitted = fs.fit_standardizer(
        base.features, base.customers, CFG.profile_set.standardized, "MinMax", CFG.period
    )
    return _rounded(fitted, 6, "avg_feature", "std_dev_feature")


@query
def std_apply_minmax(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder)
    return fs.feature_set(base.features, base.customers, CFG.profile_set, CFG.period)[0]


@query
def std_apply_z(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder)
    by_z = replace(CFG.profile_set, method="Z")
    scaled, _ = fs.feature_set(base.features, base.customers, by_z, CFG.period)
    return _rounded(scaled, 6, "feature_value")


@query
def std_inverse(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder)
    scaled, parameters = fs.feature_set(
        base.features, base.customers, CFG.profile_set, CFG.period
    )
    return _rounded(fs.invert_standardizer(scaled, parameters, "MinMax"), 6, "feature_value")


@query
def outlier_fence(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder, "from_totals")
    fence = fs.outlier_fence(base.features, base.customers, CFG.outliers, exact=True)
    return _rounded(fence, 4, "q25", "q75", "fence")


@query
def drop_outliers(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder, "from_totals")
    return fs.drop_outliers(base.features, base.customers, CFG.outliers, exact=True)


# Datasets ------------------------------------------------------------------------------------


def _training(spark: SparkSession, folder: str) -> tuple[mp.Base, mp.TrainingData]:
    src, base = _base(spark, folder)
    return base, mp.training_data(base, src, CFG)


@query
def training_long(spark: SparkSession, folder: str) -> DataFrame:
    return _training(spark, folder)[1].long


@query
def feature_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return _training(spark, folder)[1].dictionary


@query
def customer_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return _training(spark, folder)[1].customer_index


@query
def training_set(spark: SparkSession, folder: str) -> DataFrame:
    data = _training(spark, folder)[1]
    return ds.training_set(data.long, data.dictionary, data.customer_index)


@query
def scoring_set(spark: SparkSession, folder: str) -> DataFrame:
    base, data = _training(spark, folder)
    return ds.scoring_set(base.customers, data.feature_set, data.dictionary, data.dictionary)


@query
def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    data = _training(spark, folder)[1]
    train, test, _ = mp.split_vectors(data, CFG)
    # From what the vectors store: written out, each would be as wide as the dictionary.
    return (
        train.unionByName(test)
        .withColumn("entries", stored("features"))
        .select(
            "customer_id",
            "target",
            width_of("features").cast("long").alias("width"),
            F.size("entries").cast("long").alias("nonzero"),
            F.round(F.aggregate("entries", F.lit(0.0), lambda a, e: a + e["value"]), 6).alias("total"),
        )
    )


@query
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    pro, home = _pro_and_home(spark, folder)
    return ds.train_test_split(co.training_customers(pro, home, CFG), CFG)


# Models --------------------------------------------------------------------------------------


@query
def classifier_metrics(spark: SparkSession, folder: str) -> DataFrame:
    _, base = _base(spark, folder, "from_totals")
    metrics = mo.classifier_metrics(_stand_in_scores(base))
    return _rounded(metrics, 6, *[c for c in metrics.columns[4:]])


def _trained(spark: SparkSession, folder: str, model: str) -> tuple[Sources, mp.Base, RunConfig, mp.ProfileModel]:
    src, base = _base(spark, folder)
    cfg = replace(CFG, model=model)
    return src, base, cfg, mp.train_profile(base, src, cfg, AT)


@query
def train_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder, "gbt")[3].metrics


@query
def train_logreg(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder, "logreg")[3].metrics


@query
def model_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder, "logreg")[3].coefficients


@query
def test_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder, "logreg")[3].test_predictions


@query
def score_profile(spark: SparkSession, folder: str) -> DataFrame:
    _, base, cfg, model = _trained(spark, folder, "logreg")
    return mp.score_customers(base, model, cfg)


# Fixed coefficients, centres and cuts stand in for fitted ones, so that another engine can
# follow what scoring, assigning and the tree do with them.


def _fixed_logistic(spark: SparkSession, folder: str):
    data = _training(spark, folder)[1]
    train, test, width = mp.split_vectors(data, CFG)
    weights = [(i % 7 - 3) / 10 for i in range(width)]
    return data, train, test, mo.logistic_of(spark, weights, -0.05)


@query
def score_fixed(spark: SparkSession, folder: str) -> DataFrame:
    _, train, test, model = _fixed_logistic(spark, folder)
    scored = mo.score(model, train.unionByName(test), CFG)
    rounded = F.round("prob_typeB", 6)
    return scored.select("customer_id", "customer_idx", rounded.alias("prob_typeB"), "prediction")


@query
def test_predictions_fixed(spark: SparkSession, folder: str) -> DataFrame:
    _, _, test, model = _fixed_logistic(spark, folder)
    told = mo.test_predictions(model, test, CFG, AT)
    return _rounded(told.drop("classification_dttm"), 6, "prob_typeB")


@query
def coefficients_fixed(spark: SparkSession, folder: str) -> DataFrame:
    data, _, _, model = _fixed_logistic(spark, folder)
    return mo.coefficients(model, data.dictionary, CFG, AT).drop("creation_dttm")


@query
def score_l1_fixed(spark: SparkSession, folder: str) -> DataFrame:
    data = _training(spark, folder)[1]
    train, test, width = mp.split_vectors(data, CFG)
    centres = [[0.0] * width, [0.25] * width]
    scored = mo.score_level_1(
        mo.clusters_of(spark, centres), train.unionByName(test), CFG, AT
    )
    return scored.select("customer_id", "customer_idx", "cluster_id", "necessity_lvl_1")


def _totals_vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Vectors of the features that come from the totals, unscaled."""
    _, base = _base(spark, folder, "from_totals")
    dictionary = materialise(ds.feature_dictionary(base.features), "totals_dictionary")
    names = [row.feature_name for row in dictionary.orderBy("feature_idx").collect()]
    long = base.features.join(dictionary, "feature_name")
    return materialise(ds.feature_vectors(long, len(names)), "totals_vectors"), names


@query
def cluster_summary_fixed(spark: SparkSession, folder: str) -> DataFrame:
    vectors, names = _totals_vectors(spark, folder)
    digits = F.substring(fc.stable_hash(F.col("customer_id"), CFG.seed, "cluster"), 1, 6)
    clustered = vectors.withColumn("prediction", (F.conv(digits, 16, 10).cast("long") % 3).cast("int"))
    centres = [[0.0] * len(names), [1.0] * len(names)]
    told = mo.cluster_summary(clustered, centres, names)
    kept = ["distance", "total_stores", "total_transactions"]
    measures = [f"{name}_{kind}" for name in kept for kind in ("mean", "std")]
    return _rounded(told.select("cluster", "customers", "percentage", *measures), 4,
                    "percentage", *measures)


@query
def surrogate_tree_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """A tree of depth 2 has to find clusters that two cuts make."""
    vectors, names = _totals_vectors(spark, folder)
    values = vector_to_array("features")
    stores, months = names.index("total_stores"), names.index("months_since_last_trx")
    few = values[stores] <= 3
    cluster = F.when(few & (values[months] <= 6), 0).when(few, 1).otherwise(2)
    clustered = materialise(vectors.withColumn("cluster", cluster), "cut_clusters")
    tree = fit_surrogate_tree(clustered)
    told = tree.transform(clustered)
    return told.select("customer_id", F.col("prediction").cast("int").alias("cluster"))


@query
def tree_thresholds_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """All cuts of the tree that explains drawn clusters: no cut is much better than the next."""
    vectors, names = _totals_vectors(spark, folder)
    digits = F.substring(fc.stable_hash(F.col("customer_id"), CFG.seed, "cluster"), 1, 6)
    cluster = (F.conv(digits, 16, 10).cast("long") % 3).cast("int")
    tree = fit_surrogate_tree(materialise(vectors.withColumn("cluster", cluster), "drawn_clusters"))
    cuts = [(n, names[f], t) for n, (f, t) in tree.cuts.items()]
    told = spark.createDataFrame(cuts, "node long, feature_name string, threshold double")
    return _rounded(told, 6, "threshold")


@query
def std_apply_subset(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on some customers, saved, and applied to all as scoring does."""
    _, base = _base(spark, folder)
    half = base.customers.filter(fc.hash_below(F.col("customer_id"), CFG.seed, "half", 0.5))
    _, fitted = fs.feature_set(
        base.features, base.customers, CFG.profile_set, CFG.period, fit_customers=half
    )
    saved = sinks.publish_parquet(fitted, scratch_path(spark, "standardizer"))
    scaled, _ = fs.feature_set(
        base.features, base.customers, CFG.profile_set, CFG.period, parameters=saved
    )
    return _rounded(scaled, 6, "feature_value")


# With a company list ---------------------------------------------------------------------


def _listed_base(spark: SparkSession, folder: str) -> tuple[Sources, mp.Base]:
    src = tpch_sources(spark, folder, with_companies=True)
    return src, mp.build_base(src, CFG)


@query
def all_customers_listed(spark: SparkSession, folder: str) -> DataFrame:
    return co.all_customers(_cohorts(tpch_sources(spark, folder, with_companies=True)))


@query
def fctr_data_listed(spark: SparkSession, folder: str) -> DataFrame:
    src = tpch_sources(spark, folder, with_companies=True)
    return _doubles(
        co.invoice_totals(_cohorts(src), src, CFG),
        "total_sales_amt",
        "total_sales_amt_fctr",
        "total_units_cnt",
        "total_units_cnt_fctr",
    )


@query
def all_features_listed(spark: SparkSession, folder: str) -> DataFrame:
    return _listed_base(spark, folder)[1].features


@query
def training_set_listed(spark: SparkSession, folder: str) -> DataFrame:
    src, base = _listed_base(spark, folder)
    data = mp.training_data(base, src, CFG)
    return ds.training_set(data.long, data.dictionary, data.customer_index)


@query
def profile_rules_listed(spark: SparkSession, folder: str) -> DataFrame:
    src, base = _listed_base(spark, folder)
    return (
        _profile(src, base)
        .groupBy("company_profile", "model")
        .agg(F.count(F.lit(1)).alias("customers"), F.count("prob_typeB").alias("scored"))
    )


def _need_data(spark: SparkSession, folder: str) -> tuple[mp.Base, DataFrame, mp.NeedData]:
    base, profile = _needs(spark, folder)
    customers = materialise(co.profile_subset(profile), "need_customers")
    return base, customers, mp.need_vectors(base, customers, CFG)


@query
def kmeans_l2(spark: SparkSession, folder: str) -> DataFrame:
    data = _need_data(spark, folder)[2]
    clusters = mo.fit_clusters(data.vectors, 4, CFG).transform(data.vectors)
    return clusters.select("customer_id", F.col("prediction").alias("cluster"))


@query
def kmeans_pca_init(spark: SparkSession, folder: str) -> DataFrame:
    data = _need_data(spark, folder)[2]
    fitted = mo.fit_clusters(data.vectors, 4, replace(CFG, cluster_init="pca"))
    return fitted.transform(data.vectors).select(
        "customer_id", F.col("prediction").alias("cluster")
    )


@query
def cluster_summary(spark: SparkSession, folder: str) -> DataFrame:
    data = _need_data(spark, folder)[2]
    fitted = mo.fit_clusters(data.vectors, 4, CFG)
    clustered = fitted.transform(data.vectors)
    return mo.cluster_summary(clustered, fitted.clusterCenters(), data.names)


@query
def kmeans_l2_certificate(spark: SparkSession, folder: str) -> DataFrame:
    data = _need_data(spark, folder)[2]
    fitted = mo.fit_clusters(data.vectors, 4, CFG)
    return certificate(data.vectors, fitted.clusterCenters())


@query
def kmeans_pca_certificate(spark: SparkSession, folder: str) -> DataFrame:
    data = _need_data(spark, folder)[2]
    fitted = mo.fit_clusters(data.vectors, 4, replace(CFG, cluster_init="pca"))
    return certificate(data.vectors, fitted.clusterCenters())


@query
def kmeans_l1_certificate(spark: SparkSession, folder: str) -> DataFrame:
    """Two clusters of the training customers over the profile features."""
    data = _training(spark, folder)[1]
    train, test, _ = mp.split_vectors(data, CFG)
    vectors = train.unionByName(test)
    return certificate(vectors, mo.fit_clusters(vectors, 2, CFG).clusterCenters())


@query
def train_logreg_certificate(spark: SparkSession, folder: str) -> DataFrame:
    data = _training(spark, folder)[1]
    train, test, _ = mp.split_vectors(data, CFG)
    vectors = train.unionByName(test)
    cfg = replace(CFG, model="logreg")
    return mo.logistic_certificate(mo.train_classifier(vectors, cfg), vectors, cfg)


def _level_1(spark: SparkSession, folder: str) -> tuple[mp.Base, DataFrame, mp.Level1Model]:
    """The typeB customers and two clusters of them over the profile features."""
    src, base = _base(spark, folder)
    profile = materialise(_profile(src, base), "profile")
    customers = materialise(co.profile_subset(profile).distinct(), "level_1_customers")
    return base, customers, mp.train_level_1(base, customers, CFG)


@query
def kmeans_l1(spark: SparkSession, folder: str) -> DataFrame:
    base, customers, model = _level_1(spark, folder)
    told = mp.score_level_1(base, customers, model, CFG, AT).filter("customer_idx >= 0")
    return told.select("customer_id", F.col("cluster_id").cast("int").alias("cluster"))


@query
def score_l1(spark: SparkSession, folder: str) -> DataFrame:
    base, customers, model = _level_1(spark, folder)
    return mp.score_level_1(base, customers, model, CFG, AT)


@query
def l1_fill(spark: SparkSession, folder: str) -> DataFrame:
    src, base = _base(spark, folder, *NEED_FAMILIES)
    customers = materialise(co.profile_subset(_profile(src, base)), "level_1_customers")
    labelled = (
        _stand_in_scores(base)
        .join(customers.distinct(), "customer_id", "left_semi")
        .withColumn("cluster_id", F.col("prediction").cast("long"))
        .withColumn(
            "necessity_lvl_1",
            F.when(F.col("prediction") == 1, "typeB_B").otherwise("typeB_A"),
        )
    )
    scored = mo.with_run(labelled, CFG, AT, mo.CLUSTER_MODEL).select(
        "country_id",
        "model",
        "classification_dttm",
        "period",
        "customer_idx",
        "customer_id",
        "cluster_id",
        "necessity_lvl_1",
    )
    return mo.fill_level_1(scored, customers, CFG, AT).select(
        "customer_id", "customer_idx", "cluster_id", "necessity_lvl_1"
    )


def _need_model(spark: SparkSession, folder: str) -> mp.NeedModel:
    base, profile = _needs(spark, folder)
    customers = materialise(co.profile_subset(profile), "need_customers")
    return mp.train_need(base, customers, CFG)


@query
def surrogate_tree(spark: SparkSession, folder: str) -> DataFrame:
    return _need_model(spark, folder).summary


@query
def tree_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    splits = _need_model(spark, folder).splits
    return spark.createDataFrame(list(splits.items()), "feature_name string, threshold double")


# Rules -----------------------------------------------------------------------------------------


def _register_rules() -> None:
    for rule in ru.RULES:

        def run(spark: SparkSession, folder: str, rule: str = rule) -> DataFrame:
            src, base = _base(spark, folder, "from_totals")
            return _profile(src, base, rule).drop("classification_dttm")

        QUERIES[f"rule_{rule}"] = run


_register_rules()


@query
def profile_rules(spark: SparkSession, folder: str) -> DataFrame:
    src, base = _base(spark, folder, "from_totals")
    return (
        _profile(src, base)
        .groupBy("company_profile", "model")
        .agg(F.count(F.lit(1)).alias("customers"), F.count("prob_typeB").alias("scored"))
    )


def _assigned(spark: SparkSession, folder: str) -> tuple[mp.Base, DataFrame, DataFrame]:
    base, profile = _needs(spark, folder)
    customers = co.profile_subset(profile)
    return base, profile, ru.assign_needs(customers, base.features, THRESHOLDS, CFG, AT)


@query
def l2_assign(spark: SparkSession, folder: str) -> DataFrame:
    return _assigned(spark, folder)[2].select("customer_id", "cluster_id", "necessity_lvl_2")


@query
def l2_override(spark: SparkSession, folder: str) -> DataFrame:
    _, profile, needs = _assigned(spark, folder)
    return ru.override_needs(needs, profile).select(
        "customer_id", "model", "cluster_id", "necessity_lvl_2"
    )


@query
def l2_recency(spark: SparkSession, folder: str) -> DataFrame:
    return _assigned(spark, folder)[2].select("customer_id", "necessity_lvl_2_recency")


@query
def final_results(spark: SparkSession, folder: str) -> DataFrame:
    base, profile = _needs(spark, folder)
    return co.final_results(profile, mp.need_results(base, profile, THRESHOLDS, CFG, AT))
