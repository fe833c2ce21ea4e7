"""What a pass of a boosted fit counts: joint codes, the smaller child, and several settings without a job for every level."""

from __future__ import annotations

from dataclasses import replace

import numpy as np

from tariffa.config import BoostingConfig
from tariffa.operators import boosting, histogram_trees
from tariffa.operators.features import LOG_FEATURES
from tests.test_histogram_trees import rows_of


def test_columns_are_counted_together(spark):
    rng = np.random.default_rng(2)
    layout = histogram_trees.Layout([58, 626, 2, 12, 7], [np.arange(31.0)] * 6)
    assert len(layout.joint) <= 5 and sorted(m[0] for group in layout.joint for m in group) == list(range(11))
    codes = [rng.integers(0, n + 1, 5000) for n in layout.labels] + [rng.integers(0, 32, 5000) for _ in layout.cuts]
    places = np.stack([np.where(c == n, layout.size - 1, c + s) for c, n, s in zip(codes, layout.labels, layout.starts, strict=False)] + [c + s for c, s in zip(codes[5:], layout.starts[5:], strict=True)])
    block = {"at": 3, "y": rng.integers(0, 2, 5000).astype(float), "scores": rng.random((1, 5000))}
    # a split of the second column and one of a number above it
    steps = [(0, 1, layout.starts[1] + 5, True), (1, 7, layout.starts[7] + 10, False)]
    pending = [([(0, 2, layout.starts[2], True)], np.array([0.0, 0.1, -0.2]))]
    plan = histogram_trees.plan_of(0, True, 10.0, 0.7, (1, 4), pending, steps, np.array([-1, -1, 0, 1, -1, -1, -1]))
    (plain,) = next(histogram_trees.histograms(iter([block | {"x": places}]), layout.size, [plan]))
    joint = block | {"x": histogram_trees.joint_codes(codes, layout.joint)}
    for own in (joint, joint | {"kept": {}}):
        (found,) = next(histogram_trees.histograms(iter([own]), layout.size, [plan], layout.joint))
        np.testing.assert_array_equal(found[:2], plain[:2])
        np.testing.assert_allclose(found[2], plain[2], rtol=1e-10, atol=1e-9)


def test_the_larger_child_is_not_counted(spark):
    layout = histogram_trees.Layout([3], [np.arange(4.0)])
    estimator = boosting._frequency_estimator(BoostingConfig(frequency_trees=2, frequency_depth=3, frequency_feature_share="all", frequency_min_rows=1, frequency_subsample=1.0))
    fit = histogram_trees.Fit(0, estimator, 1.0, layout)
    rng = np.random.default_rng(1)
    codes = [rng.integers(0, 3, 2000), rng.integers(0, 5, 2000)]
    block = {"at": 0, "x": histogram_trees.joint_codes(codes, layout.joint), "y": (rng.random(2000) < 0.2 + 0.1 * codes[1]).astype(float), "scores": np.zeros((1, 2000))}
    counted = []
    while not fit.done:
        plan = fit.plan()
        (found,) = next(histogram_trees.histograms(iter([dict(block)]), layout.size, [plan], layout.joint))
        # every row has a place in each of the two columns
        counted.append((fit.level, found[0].sum() / 2))
        fit.learn(found)
        if fit.trees:
            break
    assert counted[0] == (0, 2000) and all(n <= 1000 for level, n in counted if level)
    # what was left over adds up
    tree = fit.trees[0]
    for h in np.flatnonzero(tree.column >= 0):
        assert tree.count[h] == tree.count[2 * h + 1] + tree.count[2 * h + 2]


def test_settings_on_one_task_start_few_jobs_and_fit_as_alone(spark):
    """The seven settings of the sweep were a job for each level of 3,200 trees."""
    rows = rows_of(spark, 2000, 8, values=500).persist()
    config = BoostingConfig(frequency_trees=30, frequency_min_rows=5)
    grid = [config, replace(config, frequency_depth=3), replace(config, positive_weight=10.0)]
    encoder = boosting.Pipeline(stages=boosting.encoder_stages("__ml_x")).fit(rows)
    context = spark.sparkContext

    def fitted(settings):
        with boosting.training_rows(encoder, rows, boosting.frequency_labels()) as ready:
            pairs = [(boosting._frequency_estimator(c), c.positive_weight) for c in settings]
            return [m.toDebugString.split("\n", 1)[1] for m, _ in histogram_trees.boost(ready, boosting.label_numbers(encoder), LOG_FEATURES, pairs)]

    context.setJobGroup("settings", "settings")
    try:
        together = fitted(grid)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("settings")) < 50
    assert together == [fitted([c])[0] for c in grid]
