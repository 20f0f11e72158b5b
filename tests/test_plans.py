"""Scalar rules: the class-balance plan (T5) and the search-space draws (M2)."""
from noisyframe.operators import learn as LN
from noisyframe.operators import sampling as SM


def test_balance_plan_cases():
    # under the cap: everything kept
    assert SM.balance_plan(1000, 9000, 20000) == (1000, 9000)
    # very imbalanced: all positives, negatives fill the cap
    assert SM.balance_plan(500, 20000, 20000) == (500, 4500)
    # positives are the larger class: the rule runs on the swapped counts
    assert SM.balance_plan(9000, 3000, 6000) == (4000, 2000)
    # balanced classes above the cap: proportional
    assert SM.balance_plan(10000, 12000, 11000) == (5000, 6000)


def test_search_draws_stay_in_space():
    for p in LN.random_params(50, 3):
        assert 0.01 <= p["step"] <= 0.07
        assert p["max_depth"] in (2, 3, 4, 5, 6)
        assert p["feature_subset"] == "all" or 0.5 <= float(p["feature_subset"]) < 1.0
        assert 0.5 <= p["subsample"] <= 1.0 and 1 <= p["min_instances"] <= 10
    assert LN.random_params(5, 1) == LN.random_params(5, 1)
