import random

import pytest

from duewise.operators import boosting, modelling
from duewise.queries import model_queries
from duewise.session import staged


def _enriched(spark, n=900, seed=5):
    draw, rows = random.Random(seed), []
    for i in range(n):
        x = draw.gauss(0, 1)
        cured = 1 if x + draw.gauss(0, 0.5) > 0 else 0
        rows.append((i % 200, i, i, 1, 600.0, x if i % 9 else None, draw.choice(["a", "b", None]), cured, 50.0 * draw.random() if cured else 0.0))
    return staged(spark.createDataFrame(
        rows, "customer_id long, credit_id long, due_day int, number int, amount_due double, hist_x double, NAME_BAND string, "
              "cured_in_horizon int, recovered_in_horizon double"), "enriched")


@pytest.fixture
def grown(spark, monkeypatch):
    """What both boosters are asked for: most trees and depth; a leaf alone takes the place of their trees."""
    asked = {}
    leaf = boosting.Tree([-1], [0.0], [None], [-1], [-1], [0.1])

    def booster(name):
        def grow(*args, **kwargs):
            numbers = [a for a in args if isinstance(a, int)]
            asked[name] = tuple(numbers[:2])
            return boosting.TreeEnsemble([leaf], [1.0])

        return grow

    data = _enriched(spark)
    for name in ("enriched", "enriched_events"):
        monkeypatch.setattr(model_queries, name, lambda spark, folder: data)
    for name in ("boost_classifier", "boost_absolute"):
        monkeypatch.setattr(boosting, name, booster(name))
    return asked


WHOLE = (modelling.TREES, modelling.DEPTH)


def test_the_classifier_query_may_grow_all_trees(spark, grown):
    model_queries.QUERIES["train_cure_model"](spark, "")
    assert grown == {"boost_classifier": WHOLE} and WHOLE == (1_000, 6)


def test_the_amount_query_may_grow_all_trees(spark, grown):
    model_queries.QUERIES["train_amount_model"](spark, "")
    assert grown == {"boost_absolute": WHOLE}


@pytest.mark.parametrize("query", ["score_events", "train_hurdle"])
def test_both_parts_of_the_hurdle_may_grow_all_trees(spark, grown, query):
    model_queries.QUERIES[query](spark, "")
    assert grown == {"boost_classifier": WHOLE, "boost_absolute": WHOLE}
