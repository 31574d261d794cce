from __future__ import annotations

from dataclasses import replace

from clientela.plans import monthly
from clientela.plans.monthly import run_month
from clientela.sources.sinks import COMPLETE, latest_version, version_path
from clientela.sources.tpch import TPCH_RUN, tpch_sources

AT = "2001-01-02 00:00:00"


def test_month_from_sales_to_final_table(spark, testdata, tmp_path):
    cfg = replace(
        TPCH_RUN, model="logreg", logreg_iterations=20, cluster_iterations=20, cluster_restarts=1
    )
    src = tpch_sources(spark, testdata)
    folder = str(tmp_path)
    fallback = {"total_sales_amt": 600000.0, "per_trx_frec_N0": 0.6, "months_since_last_trx": 6.0}
    final = run_month(src, cfg, folder, AT, fallback_thresholds=fallback)
    profiles = {r.company_profile for r in final.select("company_profile").distinct().collect()}
    assert {"typeB", "GGEE"} <= profiles
    typed = final.filter("company_profile = 'typeB'")
    assert typed.filter("company_necessity IS NULL").count() == 0
    first = sorted(map(tuple, final.collect()), key=str)
    # Scoring alone uses what the training left, and publishes the same table again.
    again = run_month(src, cfg, folder, AT, train=False, train_needs=False)
    assert sorted(map(tuple, again.collect()), key=str) == first
    # A later training is another version; the first one still gives its scores.
    later = replace(cfg, logreg_iterations=1, seed=3)
    run_month(src, later, folder, "2001-02-02 00:00:00", fallback_thresholds=fallback)
    back = run_month(src, cfg, folder, AT, train=False, train_needs=False, version=AT)
    assert sorted(map(tuple, back.collect()), key=str) == first


def test_level_1_is_saved_and_loaded(spark, testdata, tmp_path):
    cfg = replace(TPCH_RUN, cluster_iterations=20, cluster_restarts=1)
    src = tpch_sources(spark, testdata)
    base = monthly.build_base(src, cfg)
    customers = base.customers.filter("target = 0").select("customer_id").distinct()
    for start in ("random", "pca"):
        chosen = replace(cfg, cluster_init=start)
        model = monthly.train_level_1(base, customers, chosen)
        version = version_path(str(tmp_path / start), AT)
        monthly.save_level_1(model, version)
        assert latest_version(spark, str(tmp_path / start), COMPLETE) == version
        told = monthly.score_level_1(base, customers, model, chosen, AT)
        loaded = monthly.load_level_1(spark, version, chosen)
        again = monthly.score_level_1(base, customers, loaded, chosen, AT)
        assert sorted(map(tuple, told.collect()), key=str) == sorted(
            map(tuple, again.collect()), key=str
        )
        assert told.count() == customers.count()


def test_month_with_a_company_list(spark, testdata, tmp_path):
    """The default input of a run: an invoice cohort that is given, not derived."""
    cfg = replace(
        TPCH_RUN, model="logreg", logreg_iterations=20, cluster_iterations=20, cluster_restarts=1,
        percentile=0,
    )
    src = tpch_sources(spark, testdata, with_companies=True)
    fallback = {"total_sales_amt": 600000.0, "per_trx_frec_N0": 0.6, "months_since_last_trx": 6.0}
    final = run_month(src, cfg, str(tmp_path), AT, fallback_thresholds=fallback)
    assert final.count() > 0
