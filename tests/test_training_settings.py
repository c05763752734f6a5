import pytest

from tagmill.operators import model
from tagmill.plans.catalogue import QUERIES


@pytest.mark.parametrize("name, depth", [("m5_train_score", 6), ("m10_score_labelled", 6), ("m11_stack", 2)])
def test_queries_train_as_long_as_the_operator(spark, folder, monkeypatch, name, depth):
    fitted, train = [], model.train

    def recorded(*args, **settings):
        fitted.append(train(*args, **settings))
        return fitted[-1]

    monkeypatch.setattr(model, "train", recorded)
    QUERIES[name](spark, folder)
    assert [(m.getNumTrees, m.getMaxDepth()) for m in fitted] == [(20, depth)]
