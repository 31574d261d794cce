from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace

import pytest
from micro import CFG, ids, sources

from clientela.operators import cohorts as co
from clientela.operators import rules as ru

AT = "2001-01-02 00:00:00"


def scored_rows(spark, rows):
    return spark.createDataFrame(
        [(c, i, t, p, int(p > 0.5)) for i, (c, t, p) in enumerate(rows)],
        "customer_id string, customer_idx long, target int, prob_typeB double, prediction int",
    )


def cohort_sets(spark, invoice, direct, large):
    def one(values):
        return spark.createDataFrame([(v,) for v in values], "customer_id string")

    register = spark.createDataFrame(large, "customer_id string, sales_tranche int")
    return co.Cohorts(direct=one(direct), large=register, invoice=one(invoice), receipt=one([]))


def step_by_step(scored, invoice, loyalty, excluded, direct, large, low=4, high=7):
    """Insert and update a list of rows, rule by rule."""
    table = []
    for customer, target, p in scored:
        rule = "factura" if target == 1 else None
        table.append([customer, rule, "typeB" if target == 1 or p > 0.5 else "typeA"])
    known = {c for c, _, _ in scored}
    table += [[c, "factura", "typeB"] for c in invoice if c not in known]
    present = {r[0] for r in table}
    table += [
        [c, "lp", "typeB"]
        for c in loyalty
        if c not in present and c not in excluded and c not in direct
    ]
    for row in table:
        if row[0] in loyalty:
            row[1:] = ["lp", "typeB"]
    present = {r[0] for r in table}
    table += [[c, "vvee", "typeB"] for c in direct if c not in present]
    present = {r[0] for r in table}
    table += [[c, "sii", "typeB"] for c, t in large if t is not None and t < high and c not in present]
    registered = {c for c, _ in large}
    for row in table:
        if row[0] in registered:
            row[1:] = ["sii", "typeB"]
    table += [[c, "ggee", "GGEE"] for c, t in large if t is not None and t >= high]
    middle = {c for c, t in large if t is not None and low <= t < high}
    for row in table:
        if row[0] in middle:
            row[1:] = ["l2a_sii", "typeB"]
    return Counter(
        (c, "gbt" + (ru.RULE_SUFFIX[rule] if rule else ""), profile) for c, rule, profile in table
    )


def run(spark, case, cfg=CFG):
    scored, invoice, loyalty, excluded, direct, large = case
    src = sources(spark, [], loyalty=loyalty, exclusions=excluded)
    result = ru.apply_profile_rules(
        scored_rows(spark, scored), cohort_sets(spark, invoice, direct, large), src, cfg, AT
    )
    return Counter((r.customer_id, r.model, r.company_profile) for r in result.collect())


@pytest.mark.parametrize("seed", range(4))
def test_equals_rule_by_rule(spark, seed):
    rng = random.Random(seed)
    people = [str(i) for i in range(120)]

    def some(share):
        return [p for p in people if rng.random() < share]

    scored = [(p, rng.randrange(2), rng.random()) for p in some(0.4)]
    direct = [p for p in some(0.2) if p not in {s[0] for s in scored}]
    invoice = [p for p in some(0.3) if p not in direct]
    loyalty = some(0.3)
    large = sorted({(p, rng.choice([1, 5, 9])) for p in some(0.3) for _ in range(2)})
    case = (scored, invoice + invoice[:3], loyalty + loyalty[:2], some(0.1), direct, large)
    assert run(spark, case) == step_by_step(*case)


def test_missing_ids_match_nothing(spark):
    case = ([("a", 0, 0.1)], [None, "b"], [], [], [None], [("c", None)])
    assert run(spark, case) == Counter(
        {
            ("a", "gbt", "typeA"): 1,
            (None, "gbt (BR - Factura)", "typeB"): 1,
            ("b", "gbt (BR - Factura)", "typeB"): 1,
            (None, "gbt (BR - VVEE PRO)", "typeB"): 1,
        }
    )


def test_large_company_rows_can_be_made_unique(spark):
    case = ([("a", 0, 0.1)], [], [], [], [], [("a", 9), ("b", 9)])
    assert sum(run(spark, case).values()) == 3
    assert sum(run(spark, case, replace(CFG, dedupe_ggee=True)).values()) == 2


def test_needs(spark):
    names = "customer_id string, feature_name string, feature_value double"
    rows = [
        ("big", "total_sales_amt", 101.0), ("big", "months_since_last_trx", 6.0),
        ("edge", "total_sales_amt", 100.0), ("edge", "per_trx_frec_N0", 0.9),
        ("edge", "total_transactions", 3.0), ("edge", "months_since_last_trx", 7.0),
        ("few", "per_trx_frec_N0", 0.9), ("few", "total_transactions", 2.0),
    ]
    features = spark.createDataFrame(rows, names)
    customers = spark.createDataFrame([("big",), ("edge",), ("few",), ("none",)], "customer_id string")
    limits = ru.NeedThresholds(100.0, 0.5, 6.0)
    needs = ru.assign_needs(customers, features, limits, CFG, AT)
    got = {
        r.customer_id: (r.cluster_id, r.necessity_lvl_2, r.necessity_lvl_2_recency)
        for r in needs.collect()
    }
    assert got == {
        "big": (0, "L2A", "NO FUGADO"),
        "edge": (1, "L2B", "FUGADO"),
        "few": (2, "L2C", "FUGADO"),
        "none": (2, "L2C", "FUGADO"),
    }
    profile = spark.createDataFrame(
        [("none", "gbt (BR - L2A SII)"), ("none", "gbt (BR - L2A SII)"), ("few", "gbt")],
        "customer_id string, model string",
    )
    changed = {r.customer_id: r for r in ru.override_needs(needs, profile).collect()}
    assert len(changed) == 4
    assert (changed["none"].cluster_id, changed["none"].necessity_lvl_2) == (2, "L2A")
    assert changed["none"].model.endswith(" - BR SSII")
    assert changed["few"].necessity_lvl_2 == "L2C"


def test_thresholds_must_be_complete():
    with pytest.raises(ValueError, match="per_trx_frec_N0"):
        ru.NeedThresholds.from_tree({"total_sales_amt": 1.0, "months_since_last_trx": 2.0})
    filled = ru.NeedThresholds.from_tree(
        {"total_sales_amt": 1.0, "months_since_last_trx": 2.0},
        {"total_sales_amt": 9.0, "per_trx_frec_N0": 0.5},
    )
    assert filled == ru.NeedThresholds(1.0, 0.5, 2.0)


def test_profile_subset_and_final(spark):
    profile = spark.createDataFrame(
        [("CL", "a", "typeB"), ("CL", "b", "typeA"), ("CL", "a", "GGEE")],
        "country_id string, customer_id string, company_profile string",
    )
    assert ids(co.profile_subset(profile)) == ["a"]
    needs = spark.createDataFrame(
        [("a", "L2A", "FUGADO")],
        "customer_id string, necessity_lvl_2 string, necessity_lvl_2_recency string",
    )
    rows = {tuple(r) for r in co.final_results(profile, needs).collect()}
    assert rows == {
        ("CL", "a", "typeB", "L2A", "FUGADO"),
        ("CL", "b", "typeA", None, None),
        ("CL", "a", "GGEE", "L2A", "FUGADO"),
    }
