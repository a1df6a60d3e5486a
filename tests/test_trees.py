"""Saved trees as rows: nodes against the model, leaves against the training rows routed by hand."""

import math

import pytest

from tabreg.operators import estimators, features, trees
from tabreg.plans import model_queries as MQ
from tabreg.session import shared_dir
from tabreg.sources import model_store
from conftest import SF0001

NAMES = MQ.SPLIT_FEATURES


@pytest.fixture(scope="module")
def train(spark):
    return MQ._split_data(spark, SF0001).where("is_train").persist()


@pytest.fixture(scope="module")
def rows(train):
    return [r.asDict() for r in train.select(*NAMES, "y").collect()]


def _saved(spark, model):
    nodes = trees.tree_nodes(spark, model_store.save_model(model, shared_dir(spark, "t")), NAMES)
    by = {}
    for r in nodes.collect():
        by.setdefault(r.tree, {})[r.path] = r
    return nodes, by


def _leaf(tree, row):
    at = ""
    while tree[at].feature is not None:
        at += "L" if row[tree[at].feature] <= tree[at].threshold else "R"
    return at


def _forest(spark, train, **params):
    return estimators.random_forest("y", features.FEATURES, spark=spark, **params).fit(train)


def test_one_tree(spark, train, rows):
    model = estimators.decision_tree("y", features.FEATURES, spark=spark, maxDepth=3).fit(train)
    _, by = _saved(spark, model)
    tree = by[0]
    assert len(tree) == model.numNodes and tree[""].n_rows == len(rows)
    for path, r in tree.items():
        assert r.depth == len(path) and (r.leaf is None) == (r.feature is not None) == (r.threshold is not None)
        if r.feature is not None:
            left, right = tree[path + "L"], tree[path + "R"]
            assert left.n_rows + right.n_rows == r.n_rows
            assert left.prediction * left.n_rows + right.prediction * right.n_rows == pytest.approx(r.prediction * r.n_rows)
    assert [r.leaf for r in sorted((r for r in tree.values() if r.leaf is not None), key=lambda r: r.leaf)] == list(
        range(sum(r.leaf is not None for r in tree.values())))
    at = {}
    for r in rows:
        at.setdefault(_leaf(tree, r), []).append(r["y"])
    for path, ys in at.items():
        assert tree[path].n_rows == len(ys) and tree[path].prediction == pytest.approx(sum(ys) / len(ys))


def test_feature_draws_give_group_means(spark, train, rows):
    """No row draws: a leaf predicts the mean of the training rows in it; trees differ by the features they drew."""
    model = _forest(spark, train, numTrees=20, bootstrap=False, featureSubsetStrategy="onethird")
    nodes, by = _saved(spark, model)
    assert estimators.chosen_params(model)["numTrees"] == len(by) == 20
    assert len({tuple((p, r.feature, r.threshold) for p, r in sorted(t.items())) for t in by.values()}) > 1
    got = {(r.tree, r.path): r for r in trees.leaf_means(model, train, nodes, "y").collect()}
    assert len(got) == sum(r.leaf is not None for t in by.values() for r in t.values())
    for r in got.values():
        assert r.n_draws == r.n_train > 0 and r.prediction == pytest.approx(r.mean_train)
    want = {}
    for row in rows:
        for t, tree in by.items():
            want[t, _leaf(tree, row)] = want.get((t, _leaf(tree, row)), 0) + 1
    assert want == {k: r.n_train for k, r in got.items()}


def test_row_draws(spark, train, rows):
    """The default forest: each tree saw about n draws, each leaf about as many as it has rows."""
    model = _forest(spark, train)
    nodes, by = _saved(spark, model)
    assert len(by) == 20 and model.getOrDefault("maxBins") == 7500 and model.getOrDefault("maxDepth") == 5
    n = len(rows)
    roots = [t[""].n_rows for t in by.values()]
    assert len(set(roots)) > 1 and all(abs(x - n) < 5 * math.sqrt(n) for x in roots)
    mean = sum(r["y"] for r in rows) / n
    for tree in by.values():
        root = tree[""]
        # the root's draws are of all rows, so its mean is off by chance only (a leaf's also by the choice of its split)
        assert abs(root.prediction - mean) < 5 * math.sqrt(root.impurity / n)
        for path, r in tree.items():
            if r.feature is not None:
                left, right = tree[path + "L"], tree[path + "R"]
                assert left.n_rows + right.n_rows == r.n_rows
                assert left.prediction * left.n_rows + right.prediction * right.n_rows == pytest.approx(r.prediction * r.n_rows)
    got = trees.leaf_means(model, train, nodes, "y").collect()
    assert all(abs(r.n_draws - r.n_train) < 6 * math.sqrt(r.n_train) for r in got)
    assert any(r.n_draws != r.n_train for r in got)
    for t in by:
        assert sum(r.n_train for r in got if r.tree == t) == n
    # the forest predicts the mean of its trees
    for s in model.transform(train).select(*NAMES, "prediction").limit(200).collect():
        preds = [tree[_leaf(tree, s.asDict())].prediction for tree in by.values()]
        assert s.prediction == pytest.approx(sum(preds) / len(preds))


def test_leaf_without_rows_and_stump(spark, train):
    model = estimators.decision_tree("y", features.FEATURES, spark=spark, maxDepth=0).fit(train)
    nodes, by = _saved(spark, model)
    assert list(by[0]) == [""] and by[0][""].leaf == 0 and by[0][""].gain is None
    r = trees.leaf_means(model, train.where("y < 0"), nodes, "y").collect()
    assert [(x.n_train, x.mean_train) for x in r] == [(0, None)]


def test_forest_query(spark, train, rows):
    got = MQ.q_forest_leaves(spark, SF0001).collect()
    assert {r.num_trees for r in got} == {20} and {r.tree for r in got} == set(range(20))
    total = sum(r["y"] for r in rows)
    for t in range(20):
        mine = [r for r in got if r.tree == t]
        assert sum(r.n_train for r in mine) == len(rows) and len({r.path for r in mine}) == len(mine) <= 32
        assert sum(r.n_train * r.mean_train for r in mine if r.n_train) == pytest.approx(total, rel=1e-6)
