"""Regression, boosting and attribution: identities and guards."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tariffa.config import BoostingConfig, GlmConfig
from tariffa.operators import attribution, boosting, features, glm, rating
from tariffa.plans import catalog

GLM = GlmConfig(category_min_exposure=30, route_min_exposure=20)
BOOST = BoostingConfig(
    frequency_trees=3, frequency_step=0.3, frequency_min_rows=5, severity_trees=3, severity_step=0.3, severity_depth=2
)


@pytest.fixture(scope="module")
def claims(spark, folder):
    return catalog.stages(spark, folder).baseline


@pytest.fixture(scope="module")
def fitted(claims):
    return glm.fit_two_part(rating.eligible_rows(claims), GLM)


@pytest.fixture(scope="module")
def priced(claims, fitted):
    from tariffa.sources.sinks import stored

    return stored(glm.glm_pricing(claims, config=GLM, model=fitted))


def test_glm_identities(claims, fitted):
    scored = fitted.score(fitted.features(rating.eligible_rows(claims)))
    row = scored.agg(F.sum("covered_claim_flag"), F.sum("pred_frequency")).first()
    assert abs(row[0] - row[1]) < 1e-4 * row[0]
    losses = features.claims_only(scored).agg(F.count("*"), F.sum(F.col("net_loss") / F.col("pred_severity"))).first()
    assert abs(losses[0] - losses[1]) < 1e-3 * losses[0]


def test_unseen_label_scores_as_base(claims, fitted):
    rows = fitted.features(rating.eligible_rows(claims)).limit(5)
    base = fitted.frequency.labels["purchase_month_cat"][0]
    unseen = fitted.frequency.score(rows.withColumn("purchase_month_cat", F.lit("99")))
    known = fitted.frequency.score(rows.withColumn("purchase_month_cat", F.lit(base)))
    assert unseen.agg(F.sum("pred_frequency")).first() == known.agg(F.sum("pred_frequency")).first()


def test_scores_are_those_of_the_fitted_pipeline_without_vectors(claims, fitted):
    """The model's own transform, where every row is a vector of all levels, is the reference."""
    rows = fitted.features(rating.eligible_rows(claims)).withColumn(
        "purchase_month_cat", F.when(F.col("order_id") % 7 == 0, F.lit("99")).when(F.col("order_id") % 7 != 1, F.col("purchase_month_cat"))
    )
    for part in (fitted.frequency, fitted.severity):
        known = {f"__known_{c}": F.when(F.col(c).isin(own), F.col(c)).otherwise(own[0]) for c, own in part.labels.items()}
        theirs = part.pipeline.transform(rows.withColumns(known)).withColumnRenamed(part.prediction, "theirs")
        scored = part.score(theirs)
        gap = F.max(F.abs(F.col(part.prediction) / F.col("theirs") - 1.0))
        assert scored.agg(gap).first()[0] < 1e-12 and scored.columns == [*theirs.columns, part.prediction]
        alone = part.score(rows)
        assert "UDF" not in alone._jdf.queryExecution().executedPlan().toString() and alone.columns == [*rows.columns, part.prediction]
        with pytest.raises(Exception, match="not a number"):
            part.score(rows.withColumn("log_price", F.lit(float("nan")))).agg(F.sum(part.prediction)).collect()


def test_fitted_means_keep_inside_their_bounds(spark):
    etas = spark.createDataFrame([(-800.0,), (0.0,), (800.0,)], "eta double")
    logit, log = ([r[0] for r in etas.select(glm.fitted_mean(F.col("eta"), link)).collect()] for link in ("logit", "log"))
    assert logit == [1e-16, 0.5, 1.0 - 1e-16] and log == [1e-16, 1.0, 1.7976931348623157e308]


def test_coefficients_are_named(spark, fitted):
    table = glm.coefficient_table(fitted.frequency, "frequency", spark).collect()
    assert len(table) == len(fitted.frequency.terms())
    assert table[-1]["term"] == "Intercept"
    assert all(abs(r["relativity"] - np.exp(r["coefficient"])) < 1e-9 * r["relativity"] for r in table)


def test_fits_converge_and_say_how(spark, fitted):
    rows = {r["model"]: r for r in glm.fit_statistics(fitted, spark).collect()}
    assert rows["severity"]["converged"] and all(1 < r["iterations"] <= 100 for r in rows.values())


def test_terms_that_others_determine_are_left_out(spark, claims):
    """Every route is kept, so the crossing flag is a sum of routes: errors exist all the same."""
    config = GlmConfig(category_min_exposure=1, route_min_exposure=1)
    eligible = rating.eligible_rows(claims)
    counts = eligible.groupBy("cross_state_flag", "route_state").count().orderBy(F.desc("count"))
    routes = [r["route_state"] for flag in (0, 1) for r in counts.filter(F.col("cross_state_flag") == flag).head(6)]
    eligible = eligible.filter(F.col("route_state").isin(routes))
    rows = features.prepare_features(eligible, *features.level_tables(eligible, 1, 1), missing_parts="fail")
    model = glm.fit_regression(rows, "covered_claim_flag", "binomial", "logit", "p", config)
    assert any(t.startswith("cross_state") for t in model.aliased)
    table = glm.coefficient_table(model, "frequency", spark)
    assert table.filter("standard_error IS NULL OR isnan(standard_error)").count() == 0
    assert table.count() == len(model.terms())
    score = model.score(rows).agg(F.sum("covered_claim_flag"), F.sum("p")).first()
    assert abs(score[0] - score[1]) < 1e-4 * score[0]


def test_the_gram_matrix_is_that_of_the_design(claims, fitted):
    rows = fitted.features(rating.eligible_rows(claims)).limit(400)
    labels = glm._labels(rows)
    terms = ["Intercept", *glm.encoded_terms(labels)]
    plain = rows.select(*labels, *features.LOG_FEATURES).toPandas()
    columns = [np.ones(len(plain))]
    for term in terms[1:]:
        name, _, level = term.partition("[")
        columns.append((plain[name] == level[:-1]).to_numpy(float) if level else plain[name].to_numpy(float))
    design = np.stack(columns, axis=1)
    np.testing.assert_allclose(glm.gram_matrix(rows, labels), design.T @ design, rtol=1e-9, atol=1e-9)


def test_no_claims_is_a_clear_error(claims):
    quiet = rating.eligible_rows(claims).withColumns({"covered_claim_flag": F.lit(0), "net_loss": F.lit(0.0)})
    with pytest.raises(ValueError, match="no covered claims"):
        glm.fit_two_part(quiet, GLM)
    with pytest.raises(ValueError, match="no covered claims"):
        boosting.fit_challenger(quiet, BOOST, GLM)


def test_challenger_prices_to_the_actual_total(priced):
    table = boosting.challenger_pricing(priced, BOOST, GLM)
    row = boosting.challenger_report(table).first()
    assert abs(row["actual_total_loss"] - row["calibrated_expected_total_loss"]) < 1e-6 * row["actual_total_loss"]
    ineligible = table.filter("claim_eligible_flag = 0").agg(
        F.max("challenger_expected_loss"), F.max("challenger_risk_score_decile")
    ).first()
    assert tuple(ineligible) == (0.0, 0)


def test_contributions_add_up(priced):
    eligible = rating.eligible_rows(priced).drop("category_group", "route_group")
    model = boosting.fit_challenger(eligible, BOOST, GLM)
    rows = model.features(eligible)
    parts = attribution.contributions(rows, model.frequency_encoder, model.frequency_model, scale=2.0)
    scored = model.score(rows, "m").select("order_id", "order_item_id", "seller_id", "product_id", "m_frequency")
    joined = parts.rows.join(scored, ["order_id", "order_item_id", "seller_id", "product_id"])
    gap = joined.agg(F.max(F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col("m_frequency")))).first()[0]
    assert gap < 1e-9
    summary = attribution.contribution_summary(parts, model.frequency_encoder, "f", "log_odds").collect()
    assert len(summary) == len(boosting.encoded_names(model.frequency_encoder))
    assert abs(sum(r["mean_abs_contribution_share"] for r in summary) - 1) < 1e-9


NODE = (
    "tree_id int, node_id int, left_id int, right_id int, prediction double, gain double, cover double, feature_index int, "
    "left_values array<double>, category_count int, tree_weight double"
)


def plain_shapley(row, leaf):
    """A leaf's payments by its definition: the average over all orders in which the players' bounds become known."""
    import itertools

    bounds, out = leaf["bounds"], {}
    for order in itertools.permutations(range(len(bounds))):
        paid = leaf["value"] * np.prod([b["share"] for b in bounds])
        known = {}
        for player in order:
            b = bounds[player]
            known[player] = float(b["low"] < row[b["feature_index"]] <= b["high"])
            now = leaf["value"] * np.prod([known.get(i, bounds[i]["share"]) for i in range(len(bounds))])
            f = b["feature_index"]
            out[f] = out.get(f, 0.0) + now - paid
            paid = now
    return {f: v / math.factorial(len(bounds)) for f, v in out.items()}


def test_added_games_against_each_leaf_alone(spark):
    """Trees that repeat cuts and cut one feature twice, with up to three features on a path."""
    rng = np.random.default_rng(5)
    leaves = []
    for tree in range(40):
        for node in range(4):
            features_ = rng.choice(4, rng.integers(0, 4), replace=False)
            bounds = [{"feature_index": int(f), "low": float(rng.integers(0, 2)), "high": float(rng.integers(2, 4)), "share": float(rng.random())} for f in features_]
            leaves.append({"tree_id": tree, "node_id": node, "value": float(rng.normal()), "bounds": bounds})
    x = rng.integers(0, 5, (50, 4)).astype(float)
    games = attribution.games_of(leaves, {f: f for f in range(4)})
    assert len(games.tests) <= 16 < len(leaves)
    want = np.zeros((50, 4))
    for r in range(50):
        for leaf in leaves:
            for f, v in plain_shapley(x[r], leaf).items():
                want[r, f] += v
    assert np.allclose(attribution.shapley_batch(x, games, most=7), want)


def test_margins_from_intervals_and_a_tampered_node(spark, priced):
    eligible = rating.eligible_rows(priced).drop("category_group", "route_group")
    model = boosting.fit_challenger(eligible, BOOST, GLM)
    nodes = attribution.node_table(model.severity_model, spark)
    rows = model.severity_encoder.transform(model.score(model.features(eligible), "m"))

    def gap(nodes_):
        found = attribution.with_interval_margin(rows, attribution.leaf_intervals(nodes_), vector_to_array("__ml_x"))
        wrong = F.abs(F.greatest(F.expm1("margin"), F.lit(0.01)) / F.col("m_severity") - 1) > 1e-9
        return found.agg(F.count_if(wrong)).first()[0]

    assert gap(nodes) == 0
    changed = F.when((F.col("tree_id") == 1) & (F.col("left_id") < 0), F.col("prediction") + 1e-3).otherwise(F.col("prediction"))
    assert gap(nodes.withColumn("prediction", changed)) > 0
    moved = F.when(F.col("node_id") == 0, F.array(F.col("left_values")[0] + 0.4)).otherwise(F.col("left_values"))
    assert gap(nodes.withColumn("left_values", F.when(F.col("category_count") == -1, moved).otherwise(F.col("left_values")))) > 0


def test_score_equations_find_a_tampered_coefficient(claims, fitted):
    rows = fitted.features(rating.eligible_rows(claims))

    def gaps(model):
        return {(r["model"], r["feature"], r["level"]): r["score_gap"] for r in glm.score_equations(model, rows).collect()}

    found = gaps(fitted)
    assert len(found) > 20 and max(abs(g) for g in found.values()) < 1e-6
    level = fitted.frequency.labels["category_group"][1]

    class Tampered(glm.TwoPartGlm):
        def score(self, df):
            scored = super().score(df)
            shifted = F.expr("pred_frequency * exp(0.01) / (1 - pred_frequency + pred_frequency * exp(0.01))")
            return scored.withColumn("pred_frequency", F.when(F.col("category_group") == level, shifted).otherwise(F.col("pred_frequency")))

    bad = gaps(Tampered(fitted.frequency, fitted.severity, fitted.categories, fitted.routes))
    assert abs(bad["frequency", "category_group", level]) > 1e-4
    assert abs(bad["frequency", "Intercept", ""]) > 1e-6 > abs(bad["severity", "Intercept", ""])


def test_sweep_fits_side_by_side_on_one_table(priced):
    from dataclasses import replace

    grid = [("a", BOOST), ("b", replace(BOOST, frequency_depth=3)), ("c", replace(BOOST, positive_weight=10.0)), ("again", BOOST)]
    sweep = boosting.parameter_sweep(priced, grid, GLM)
    table = {(r["setting"], r["split"]): r for r in boosting.sweep_report(sweep).collect()}
    assert len(table) == 8 and all(r["fit_seconds"] > 0 and 0 <= r["auc"] <= 1 for r in table.values())
    a, again, weighted = (table[name, "test"] for name in ("a", "again", "c"))
    assert (a["auc"], a["brier_score"]) == (again["auc"], again["brier_score"]) and weighted["predicted_frequency"] > a["predicted_frequency"]
    # the model of the sweep is the one a fit alone gives
    split = features.order_split(rating.eligible_rows(priced), GLM.test_size, GLM.seed)
    train = split.filter("split = 'train'")
    rows = features.prepare_features(split, *features.level_tables(train, GLM.category_min_exposure, GLM.route_min_exposure))
    encoder, model = boosting.fit_frequency(rows.filter("split = 'train'"), BOOST)
    alone = model.transform(encoder.transform(rows)).groupBy("split").agg(F.avg(vector_to_array("__gbt_p")[1])).collect()
    assert all(abs(mean - table["a", side]["predicted_frequency"]) < 1e-12 for side, mean in alone)


def test_shapley_against_all_orderings(spark):
    """One hand-made tree: the values equal the average over player orderings."""
    import itertools

    def node(i, left, right, prediction, cover, feature=-1, cut=()):
        return {
            "tree_id": 0, "node_id": i, "left_id": left, "right_id": right, "prediction": prediction, "gain": 0.0,
            "cover": cover, "feature_index": feature, "left_values": list(cut), "category_count": -1, "tree_weight": 1.0,
        }

    nodes = [
        node(0, 1, 2, 0.0, 10.0, 0, (0.5,)), node(1, 3, 4, 0.0, 6.0, 1, (0.5,)), node(2, -1, -1, 5.0, 4.0),
        node(3, -1, -1, 1.0, 2.0), node(4, -1, -1, 2.0, 4.0),
    ]
    x = np.array([[0.0, 0.0], [0.0, 1.0], [1.0, 0.0]])
    leaves = attribution.leaf_intervals(spark.createDataFrame(nodes, NODE)).collect()
    games = attribution.games_of(leaves, {0: 0, 1: 1})
    got, constant = attribution.shapley_batch(x, games, most=2), games.constant

    def value(row, known):
        inner = (1.0 if row[1] <= 0.5 else 2.0) if 1 in known else (1.0 * 2 + 2.0 * 4) / 6
        if 0 in known:
            return inner if row[0] <= 0.5 else 5.0
        return 0.6 * inner + 0.4 * 5.0

    for row, parts in zip(x, got, strict=True):
        want = np.zeros(2)
        for order in itertools.permutations((0, 1)):
            seen = set()
            for player in order:
                want[player] += (value(row, seen | {player}) - value(row, seen)) / 2
                seen.add(player)
        assert np.allclose(parts, want) and abs(constant - value(row, set())) < 1e-12


def test_registered_models_have_their_documented_size():
    from tariffa.plans import catalog, star

    assert star.BOOSTING == BoostingConfig()
    assert (star.BOOSTING.frequency_trees, star.BOOSTING.severity_trees, star.BOOSTING.severity_min_rows) == (500, 350, 1)
    settings = dict(catalog.SWEEP)
    assert settings["regularized"] == star.BOOSTING and settings["current"].frequency_step == 0.04
    assert min(c.frequency_trees for c in settings.values()) == 400
    assert settings["shallow_more"].frequency_trees > settings["depth2"].frequency_trees
