"""The registered queries once more, as SQL over the same star schema.

Each text is independent of the Spark code: it is built from the table definitions below and
runs on any engine with md5, exact quantiles and window functions.
"""

from __future__ import annotations

from tariffa.config import PORTFOLIO_SCENARIOS, RETURN_REASONS
from tariffa.plans.star import BOOSTING, CREDIBILITY, GLM, RATING, SIMULATION, SWEEP

_SIM = SIMULATION


def _d(x: float) -> str:
    """A double literal (plain decimals would be exact decimals)."""
    return f"CAST({x!r} AS DOUBLE)"


def _u(stream: str, key: str = "order_id, order_item_id, seller_id, product_id", seed: int = _SIM.seed) -> str:
    return (
        f"(CAST('0x' || substr(md5(concat_ws('|', {key}, '{seed}', '{stream}')), 1, 13) AS BIGINT)"
        " / CAST(4503599627370496.0 AS DOUBLE))"
    )


def _div(a: str, b: str, default: str = "0.0") -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE {default} END)"


def _pos(a: str, b: str, default: str = "0.0") -> str:
    return f"(CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE {default} END)"


_INPUTS = """
items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id,
         CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS price,
         l_extendedprice * l_tax AS freight_value
  FROM lineitem),
ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
         CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 90 AS INTEGER))
           + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS order_estimated_delivery_date
  FROM orders),
prod AS (
  SELECT p_partkey AS product_id, p_name AS product_category_name,
         CASE WHEN p_partkey % 97 <> 0 THEN
           CASE WHEN p_partkey % 89 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size * 850 AS DOUBLE) END
         END AS product_weight_g,
         CASE WHEN p_partkey % 97 <> 0 THEN CAST(p_size * 2 AS DOUBLE) END AS product_length_cm,
         CASE WHEN p_partkey % 97 <> 0 THEN CAST(p_partkey % 40 + 1 AS DOUBLE) END AS product_height_cm,
         CASE WHEN p_partkey % 97 <> 0 THEN CAST(p_partkey % 60 + 1 AS DOUBLE) END AS product_width_cm
  FROM part),
trans AS (
  SELECT DISTINCT p_name AS product_category_name, replace(p_name, ' ', '_') AS product_category_name_english
  FROM part WHERE p_name NOT LIKE 'red %'),
cust AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_city, n_name AS customer_state,
         CAST(c_nationkey * 100 AS INTEGER) AS customer_zip_code_prefix
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
sell AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_city, n_name AS seller_state,
         CAST(s_nationkey * 100 AS INTEGER) AS seller_zip_code_prefix
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
exposure AS MATERIALIZED (
  SELECT i.order_id, i.order_item_id, i.seller_id, i.product_id, o.customer_id, o.order_status,
         o.order_purchase_timestamp, o.order_estimated_delivery_date,
         coalesce(p.product_category_name, 'unknown') AS product_category_name,
         coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english,
         i.price, i.freight_value,
         CASE WHEN i.price <> 0 THEN i.freight_value / i.price
              WHEN i.freight_value > 0 THEN CAST('inf' AS DOUBLE) END AS freight_to_price_ratio,
         p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
         p.product_length_cm * p.product_height_cm * p.product_width_cm AS product_volume_cm3,
         s.seller_zip_code_prefix, s.seller_city, s.seller_state,
         c.customer_zip_code_prefix, c.customer_city, c.customer_state,
         s.seller_state || '_to_' || c.customer_state AS route_state,
         CAST(coalesce(s.seller_state <> c.customer_state, TRUE) AS INTEGER) AS cross_state_flag,
         CAST(month(o.order_purchase_timestamp) AS INTEGER) AS purchase_month,
         CAST(isodow(o.order_purchase_timestamp) - 1 AS INTEGER) AS purchase_weekday,
         (epoch_us(o.order_estimated_delivery_date) - epoch_us(o.order_purchase_timestamp))
           / CAST(86400000000 AS DOUBLE) AS estimated_delivery_days
  FROM items i
  LEFT JOIN ord o ON i.order_id = o.order_id
  LEFT JOIN prod p ON i.product_id = p.product_id
  LEFT JOIN trans t ON p.product_category_name = t.product_category_name
  LEFT JOIN cust c ON o.customer_id = c.customer_id
  LEFT JOIN sell s ON i.seller_id = s.seller_id)"""


def _claims_ctes(freight_cap: str, ratio_cap: str) -> str:
    category = "CASE product_category_name_english " + " ".join(
        f"WHEN '{k}' THEN {_d(v)}" for k, v in _SIM.category_factors.items()
    ) + f" ELSE {_d(1.0)} END"
    routes = ", ".join(f"'{r}'" for r in _SIM.high_freight_routes)
    reason, edge = "", 0.0
    for label, weight in RETURN_REASONS[:-1]:
        edge = round(edge + weight, 12)
        reason += f"WHEN {_u('reason')} < {_d(edge)} THEN '{label}' "
    approval = f"(CASE WHEN freight_to_price_ratio_capped > 1 THEN {_d(0.88)} ELSE {_d(0.93)} END)"
    refund = f"(CASE WHEN price < {_SIM.refund_price_limit} THEN {_d(0.05)} ELSE {_d(0.02)} END)"
    partial = f"(CASE WHEN price < {_SIM.partial_refund_price_limit} THEN {_d(0.08)} ELSE {_d(0.04)} END)"
    return f"""
medians AS (
  SELECT product_category_name_english AS cat,
         quantile_cont(CASE WHEN product_weight_g > 0 THEN product_weight_g END, 0.5) AS mw,
         quantile_cont(CASE WHEN product_volume_cm3 > 0 THEN product_volume_cm3 END, 0.5) AS mv
  FROM exposure GROUP BY 1),
overall AS (
  SELECT quantile_cont(CASE WHEN product_weight_g > 0 THEN product_weight_g END, 0.5) AS gw,
         quantile_cont(CASE WHEN product_volume_cm3 > 0 THEN product_volume_cm3 END, 0.5) AS gv
  FROM exposure),
filled AS MATERIALIZED (
  SELECT e.*,
         CAST(coalesce(order_status = '{_SIM.delivered_status}', FALSE) AS INTEGER) AS claim_eligible_flag,
         CASE WHEN freight_value > {freight_cap} THEN {freight_cap} ELSE freight_value END AS freight_value_capped,
         CASE WHEN freight_to_price_ratio > {ratio_cap} THEN {ratio_cap}
              ELSE freight_to_price_ratio END AS freight_to_price_ratio_capped,
         coalesce(CASE WHEN product_weight_g > 0 THEN product_weight_g END, mw, gw) AS product_weight_g_filled,
         CASE WHEN product_weight_g > 0 THEN 0 ELSE 1 END AS product_weight_g_imputed_flag,
         coalesce(CASE WHEN product_volume_cm3 > 0 THEN product_volume_cm3 END, mv, gv) AS product_volume_cm3_filled,
         CASE WHEN product_volume_cm3 > 0 THEN 0 ELSE 1 END AS product_volume_cm3_imputed_flag
  FROM exposure e LEFT JOIN medians m ON e.product_category_name_english = m.cat, overall),
bulky AS (
  SELECT quantile_cont(product_weight_g_filled, 0.95) AS bw, quantile_cont(product_volume_cm3_filled, 0.95) AS bv
  FROM filled),
factors AS (
  SELECT f.*,
         {category} AS return_factor_category,
         CASE WHEN route_state IN ({routes}) THEN {_d(1.2)} WHEN cross_state_flag = 1 THEN {_d(1.1)}
              ELSE {_d(0.9)} END AS return_factor_route,
         CASE WHEN freight_to_price_ratio_capped < {_d(0.15)} THEN {_d(0.9)}
              WHEN freight_to_price_ratio_capped < {_d(0.4)} THEN {_d(1.0)}
              WHEN freight_to_price_ratio_capped < {_d(0.9)} THEN {_d(1.1)}
              WHEN freight_to_price_ratio_capped >= {_d(0.9)} THEN {_d(1.25)}
              ELSE {_d(1.0)} END AS return_factor_freight_ratio,
         CASE WHEN product_weight_g_filled > bw OR product_volume_cm3_filled > bv THEN {_d(0.85)}
              ELSE {_d(1.0)} END AS return_factor_size,
         CASE WHEN purchase_month IN (11, 12) THEN {_d(1.1)} WHEN purchase_month IN (1, 2) THEN {_d(1.05)}
              ELSE {_d(1.0)} END AS return_factor_month
  FROM filled f, bulky),
probabilities AS (
  SELECT *, CASE WHEN claim_eligible_flag = 1 THEN
              least({_d(_SIM.max_return_probability)}, greatest({_d(_SIM.min_return_probability)},
                {_d(_SIM.base_return_rate)} * return_factor_category * return_factor_route
                * return_factor_freight_ratio * return_factor_size * return_factor_month))
            ELSE {_d(0.0)} END AS return_probability
  FROM factors),
requests AS (
  SELECT *, CASE WHEN return_probability > 0 AND {_u('return')} < return_probability THEN 1 ELSE 0 END
              AS return_requested
  FROM probabilities),
approvals AS (
  SELECT *, CASE WHEN return_requested = 1 AND {_u('approval')} < {approval} THEN 1 ELSE 0 END AS return_approved
  FROM requests),
refunds AS (
  SELECT *, CASE WHEN return_approved = 1 AND {_u('refund')} < {refund} THEN 1 ELSE 0 END AS refund_without_return
  FROM approvals),
events_ AS (
  SELECT *,
         CASE WHEN return_approved = 1 AND refund_without_return = 0 AND {_u('partial')} < {partial}
              THEN 1 ELSE 0 END AS partial_refund,
         CASE WHEN return_requested = 1 THEN CAST(floor({_u('day')} * 30) + 1 AS INTEGER) ELSE 0 END
           AS request_days_after_delivery,
         CASE WHEN return_requested = 1 THEN CASE {reason} ELSE '{RETURN_REASONS[-1][0]}' END ELSE 'none' END
           AS return_reason,
         CASE WHEN claim_eligible_flag = 1 AND return_requested = 1 AND return_approved = 1
               AND refund_without_return = 0 AND freight_value_capped > 0 THEN 1 ELSE 0 END AS covered_claim_flag,
         CASE WHEN claim_eligible_flag = 1 AND freight_value_capped > 0
              THEN return_probability * {approval} * ({_d(1.0)} - {refund}) ELSE {_d(0.0)} END
           AS covered_claim_probability
  FROM refunds),
gross AS (
  SELECT *,
         CASE WHEN covered_claim_flag = 1 THEN 'return_shipping' ELSE 'none' END AS claim_type,
         CASE WHEN covered_claim_flag = 1 THEN freight_value_capped
                * ({_d(0.8)} + {_u('severity')} * {_d(0.4)})
                * (CASE WHEN partial_refund = 1 THEN {_d(0.5)} ELSE {_d(1.0)} END) ELSE {_d(0.0)} END AS gross_loss
  FROM events_),
recovered AS (
  SELECT *,
         CASE WHEN covered_claim_flag = 1 AND {_u('recovery')} < {_d(_SIM.recovery_probability)}
              THEN gross_loss * ({_d(0.1)} + {_u('recovery_share')} * {_d(0.2)})
              ELSE {_d(0.0)} END AS recovery_from_carrier
  FROM gross),
claims AS MATERIALIZED (
  SELECT *,
         greatest({_d(0.0)}, gross_loss - recovery_from_carrier) AS paid_loss,
         greatest({_d(0.0)}, gross_loss - recovery_from_carrier) AS net_loss,
         CASE WHEN claim_eligible_flag = 0 THEN 'not_eligible'
              WHEN covered_claim_flag = 1 THEN 'paid'
              WHEN return_requested = 1 AND return_approved = 0 THEN 'declined_not_approved'
              WHEN return_approved = 1 AND refund_without_return = 1 THEN 'closed_refund_without_return'
              WHEN return_requested = 1 THEN 'closed_no_covered_loss'
              ELSE 'no_return' END AS claim_status
  FROM recovered)"""


_CLAIMS = _INPUTS + "," + _claims_ctes(_d(_SIM.freight_value_cap), _d(_SIM.freight_to_price_ratio_cap))

_TARGET = _d(RATING.target_loss_ratio)
_PORTFOLIO_COLUMNS = f"""
  count(*) AS row_count,
  CAST(sum(claim_eligible_flag) AS BIGINT) AS eligible_exposures,
  CAST(sum(1 - claim_eligible_flag) AS BIGINT) AS ineligible_exposures,
  CAST(sum(covered_claim_flag) AS BIGINT) AS covered_claim_count,
  sum(CASE WHEN claim_eligible_flag = 1 THEN gross_loss ELSE 0 END) AS total_gross_loss,
  sum(CASE WHEN claim_eligible_flag = 1 THEN recovery_from_carrier ELSE 0 END) AS total_recovery_from_carrier,
  sum(CASE WHEN claim_eligible_flag = 1 THEN paid_loss ELSE 0 END) AS total_paid_loss,
  sum(CASE WHEN claim_eligible_flag = 1 THEN net_loss ELSE 0 END) AS total_net_loss"""

_BASELINE = _CLAIMS + f""",
portfolio AS (
  SELECT *, {_div('total_net_loss', 'eligible_exposures')} AS pp,
         {_div('total_net_loss', 'eligible_exposures')} / {_TARGET} AS cp
  FROM (SELECT {_PORTFOLIO_COLUMNS} FROM claims)),
baseline AS MATERIALIZED (
  SELECT c.*, {_TARGET} AS target_loss_ratio, pp AS portfolio_pure_premium, cp AS portfolio_commercial_premium,
         CASE WHEN claim_eligible_flag = 1 THEN pp ELSE 0.0 END AS baseline_pure_premium,
         CASE WHEN claim_eligible_flag = 1 THEN cp ELSE 0.0 END AS baseline_commercial_premium,
         CASE WHEN claim_eligible_flag = 1 THEN pp ELSE 0.0 END AS expected_loss,
         covered_claim_probability * freight_value_capped AS glm_expected_loss,
         covered_claim_probability * freight_value_capped / {_TARGET} AS glm_commercial_premium
  FROM claims c, portfolio)"""


def _sellers(k: str, source: str = "experience", extra: str = "") -> str:
    """CTE bodies from experience to priced sellers, with ``extra`` as a partition column."""
    over = f"OVER (PARTITION BY {extra})" if extra else "OVER ()"
    low, high = _d(CREDIBILITY.relativity_min), _d(CREDIBILITY.relativity_max)
    return f"""
shrunk AS (
  SELECT *, least({high}, greatest({low}, seller_credibility_relativity_raw)) AS seller_credibility_relativity_capped
  FROM (SELECT *, seller_credibility_weight * seller_observed_ae
                  + ({_d(1.0)} - seller_credibility_weight) AS seller_credibility_relativity_raw
        FROM (SELECT *, seller_eligible_exposures / (seller_eligible_exposures + {k}) AS seller_credibility_weight
              FROM {source}))),
normalised AS (
  SELECT *, seller_credibility_relativity_capped * seller_credibility_normalization_factor
              AS seller_credibility_relativity
  FROM (SELECT *, {_div(f'sum(seller_glm_expected_loss) {over}', f'sum(seller_glm_expected_loss * seller_credibility_relativity_capped) {over}')}
               AS seller_credibility_normalization_factor FROM shrunk)),
sellers AS MATERIALIZED (
  SELECT *, seller_credibility_expected_loss / {_TARGET} AS seller_credibility_commercial_premium,
         {_pos('seller_actual_net_loss', 'seller_credibility_expected_loss')} AS seller_credibility_ae,
         CASE WHEN seller_credibility_relativity < {_d(0.9)} THEN 'lower_than_glm'
              WHEN seller_credibility_relativity < {_d(1.1)} THEN 'near_glm'
              WHEN seller_credibility_relativity < {_d(1.3)} THEN 'elevated' ELSE 'high' END AS seller_risk_tier
  FROM (SELECT *, seller_glm_expected_loss * seller_credibility_relativity AS seller_credibility_expected_loss
        FROM normalised))"""


_EXPERIENCE = _BASELINE + f""",
experience AS MATERIALIZED (
  SELECT *, seller_claim_count / CAST(seller_eligible_exposures AS DOUBLE) AS seller_observed_frequency,
         seller_actual_net_loss / seller_eligible_exposures AS seller_observed_pure_premium,
         seller_glm_expected_loss / seller_eligible_exposures AS seller_glm_pure_premium,
         {_pos('seller_actual_net_loss', 'seller_glm_expected_loss', '1.0')} AS seller_observed_ae
  FROM (SELECT seller_id, count(*) AS seller_eligible_exposures,
               CAST(sum(covered_claim_flag) AS BIGINT) AS seller_claim_count,
               sum(net_loss) AS seller_actual_net_loss,
               sum(glm_expected_loss) AS seller_glm_expected_loss,
               sum(glm_commercial_premium) AS seller_glm_commercial_premium,
               avg(glm_expected_loss) AS seller_average_glm_expected_loss,
               avg(glm_commercial_premium) AS seller_average_glm_commercial_premium,
               count(DISTINCT order_id) AS unique_orders,
               count(DISTINCT product_id) AS unique_products
        FROM baseline WHERE claim_eligible_flag = 1 GROUP BY seller_id))"""

_K = f"CAST({CREDIBILITY.k} AS DOUBLE)"
_SELLERS = _EXPERIENCE + "," + _sellers(_K)

_PUSHED = [
    "seller_eligible_exposures",
    "seller_claim_count",
    "seller_actual_net_loss",
    "seller_glm_expected_loss",
    "seller_observed_ae",
    "seller_credibility_weight",
    "seller_credibility_relativity_raw",
    "seller_credibility_relativity_capped",
    "seller_credibility_normalization_factor",
    "seller_credibility_relativity",
]
_PRICED = _SELLERS + f""",
priced AS MATERIALIZED (
  SELECT *, {_pos('credibility_expected_loss', 'glm_expected_loss')} AS credibility_expected_loss_ratio_to_glm,
         {_pos('credibility_commercial_premium', 'glm_commercial_premium')} AS credibility_premium_ratio_to_glm,
         {_pos('credibility_expected_loss', 'freight_value_capped')} AS credibility_expected_loss_ratio_to_freight
  FROM (SELECT *, credibility_expected_loss / {_TARGET} AS credibility_commercial_premium
        FROM (SELECT b.*, {", ".join(f"coalesce(CAST(s.{c} AS DOUBLE), 0.0) AS {c}" for c in _PUSHED)},
                     coalesce(s.seller_risk_tier, 'not_eligible') AS seller_risk_tier,
                     CASE WHEN claim_eligible_flag = 1
                          THEN glm_expected_loss * coalesce(s.seller_credibility_relativity, 0.0)
                          ELSE 0.0 END AS credibility_expected_loss
              FROM baseline b LEFT JOIN sellers s ON b.seller_id = s.seller_id)))"""


def _backtest(group: str = "", source: str = "priced") -> str:
    head = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    per_basis = ", ".join(
        f"{_div(f'{b}_expected_loss', 'eligible_exposures')} AS {b}_expected_pure_premium, "
        f"{_div('actual_loss', f'{b}_expected_loss')} AS {b}_ae, "
        f"{_div('actual_loss', f'{b}_commercial_premium')} AS {b}_loss_ratio, "
        f"{_div('actual_loss', f'{b}_commercial_premium')} - {_TARGET} AS {b}_loss_ratio_vs_target"
        for b in ("baseline", "glm", "credibility")
    )
    return f"""
SELECT *, abs(baseline_ae - 1) - abs(glm_ae - 1) AS glm_ae_improvement_vs_baseline,
       abs(glm_ae - 1) - abs(credibility_ae - 1) AS credibility_ae_improvement_vs_glm,
       {_div('credibility_expected_loss', 'glm_expected_loss')} - 1 AS credibility_expected_loss_change_vs_glm
FROM (SELECT *, {_div('covered_claim_count', 'eligible_exposures')} AS claim_frequency,
             {_div('actual_loss', 'covered_claim_count')} AS average_severity,
             {_div('actual_loss', 'eligible_exposures')} AS actual_pure_premium, {per_basis}
      FROM (SELECT {head}count(*) AS eligible_exposures,
                   CAST(coalesce(sum(covered_claim_flag), 0) AS BIGINT) AS covered_claim_count,
                   coalesce(sum(net_loss), 0.0) AS actual_loss,
                   coalesce(sum(baseline_pure_premium), 0.0) AS baseline_expected_loss,
                   coalesce(sum(glm_expected_loss), 0.0) AS glm_expected_loss,
                   coalesce(sum(credibility_expected_loss), 0.0) AS credibility_expected_loss,
                   coalesce(sum(baseline_commercial_premium), 0.0) AS baseline_commercial_premium,
                   coalesce(sum(glm_commercial_premium), 0.0) AS glm_commercial_premium,
                   coalesce(sum(credibility_commercial_premium), 0.0) AS credibility_commercial_premium,
                   count(DISTINCT order_id) AS unique_orders, count(DISTINCT seller_id) AS unique_sellers,
                   count(DISTINCT product_id) AS unique_products
            FROM {source} WHERE claim_eligible_flag = 1{tail}))"""


def _adequacy(ratio: str) -> str:
    return (
        f"CASE WHEN round({ratio}, 9) <= {_TARGET} THEN 'within_target' "
        f"WHEN round({ratio}, 9) <= {_d(0.8)} THEN 'above_target' "
        f"WHEN round({ratio}, 9) <= {_d(1.0)} THEN 'high_pressure' ELSE 'premium_inadequate' END"
    )


def _stress(source: str) -> str:
    """Result rows from a table with scenario, segment and multiplier columns."""
    bases = ("baseline", "glm", "credibility")
    per_basis = ", ".join(
        f"{b}_commercial_premium, {b}_stressed_loss_ratio, {b}_stressed_loss_ratio - {_TARGET} AS {b}_loss_ratio_vs_target, "
        f"{_adequacy(f'{b}_stressed_loss_ratio')} AS {b}_premium_adequacy_flag"
        for b in bases
    )
    ratios = ", ".join(
        f"{_div('portfolio_stressed_actual_loss', f'{b}_commercial_premium')} AS {b}_stressed_loss_ratio" for b in bases
    )
    return f"""
SELECT scenario, segment_type, segment_value, stressed_scope, description, eligible_exposures, covered_claim_count,
       portfolio_base_actual_loss, segment_base_actual_loss, frequency_multiplier, severity_multiplier,
       combined_loss_multiplier, segment_stressed_actual_loss,
       segment_stressed_actual_loss - segment_base_actual_loss AS segment_stressed_loss_increase,
       {_div('segment_stressed_actual_loss', 'segment_base_actual_loss')} - 1 AS segment_stressed_loss_increase_pct,
       portfolio_stressed_actual_loss,
       portfolio_stressed_actual_loss - portfolio_base_actual_loss AS portfolio_stressed_loss_increase,
       {_div('portfolio_stressed_actual_loss', 'portfolio_base_actual_loss')} - 1 AS portfolio_stressed_loss_increase_pct,
       {per_basis}
FROM (SELECT *, {ratios}
      FROM (SELECT *, portfolio_base_actual_loss - segment_base_actual_loss + segment_stressed_actual_loss
                        AS portfolio_stressed_actual_loss
            FROM (SELECT *, segment_base_actual_loss * combined_loss_multiplier AS segment_stressed_actual_loss
                  FROM (SELECT *, frequency_multiplier * severity_multiplier AS combined_loss_multiplier
                        FROM ({source})))))"""


_TOTALS = _PRICED + """,
totals AS (
  SELECT count(*) AS eligible_exposures, CAST(sum(covered_claim_flag) AS BIGINT) AS covered_claim_count,
         sum(net_loss) AS actual_loss, sum(baseline_commercial_premium) AS baseline_commercial_premium,
         sum(glm_commercial_premium) AS glm_commercial_premium,
         sum(credibility_commercial_premium) AS credibility_commercial_premium
  FROM priced WHERE claim_eligible_flag = 1)"""

_SCENARIOS = " UNION ALL ".join(
    f"SELECT '{n}' AS scenario, {_d(f)} AS frequency_multiplier, {_d(s)} AS severity_multiplier, '{t}' AS description"
    for n, f, s, t in PORTFOLIO_SCENARIOS
)
_STRESS_PORTFOLIO = _stress(
    f"""SELECT sc.*, 'portfolio' AS segment_type, 'all' AS segment_value, 'all_eligible_exposures' AS stressed_scope,
        t.*, actual_loss AS portfolio_base_actual_loss, actual_loss AS segment_base_actual_loss
        FROM totals t, ({_SCENARIOS}) sc"""
)
_PREMIUMS = "t.baseline_commercial_premium, t.glm_commercial_premium, t.credibility_commercial_premium"
_STRESS_TIER = _stress(
    f"""SELECT 'seller_tier_combined_stress' AS scenario, 'seller_tier' AS segment_type,
        seller_risk_tier AS segment_value, 'only_seller_tier' AS stressed_scope,
        'Only seller_tier=' || seller_risk_tier || ' receives frequency and severity stress.' AS description,
        g.eligible_exposures, g.covered_claim_count, t.actual_loss AS portfolio_base_actual_loss,
        g.loss AS segment_base_actual_loss, {_d(1.2)} AS frequency_multiplier, {_d(1.2)} AS severity_multiplier,
        {_PREMIUMS}
        FROM (SELECT seller_risk_tier, count(*) AS eligible_exposures,
                     CAST(sum(covered_claim_flag) AS BIGINT) AS covered_claim_count, sum(net_loss) AS loss
              FROM priced WHERE claim_eligible_flag = 1 GROUP BY 1) g, totals t"""
)


def _watch(group: str, limit: int) -> str:
    return f"""(SELECT CAST({group} AS VARCHAR) AS segment_value, eligible_exposures, covered_claim_count,
       actual_loss AS segment_base_actual_loss, credibility_loss_ratio
FROM ({_backtest(group)}) WHERE eligible_exposures >= {limit}
ORDER BY credibility_loss_ratio DESC, {group} LIMIT {RATING.watchlist_top_n})"""


_CATEGORY, _ROUTE = "product_category_name_english", "route_state"
_WATCHLIST = (
    f"SELECT 'category_watchlist' AS segment_type, * FROM {_watch(_CATEGORY, RATING.category_min_exposure)} "
    f"UNION ALL SELECT 'route_watchlist' AS segment_type, * FROM {_watch(_ROUTE, RATING.route_min_exposure)}"
)
_STRESS_WATCH = _stress(
    f"""SELECT segment_type || '_plus_15_15' AS scenario, segment_type, segment_value,
        'only_' || segment_type AS stressed_scope,
        'Only watchlist ' || segment_type || '=' || segment_value
          || ' receives frequency +15% and severity +15%.' AS description,
        w.eligible_exposures, w.covered_claim_count, t.actual_loss AS portfolio_base_actual_loss,
        w.segment_base_actual_loss, {_d(1.15)} AS frequency_multiplier, {_d(1.15)} AS severity_multiplier, {_PREMIUMS}
        FROM ({_WATCHLIST}) w, totals t"""
)


def _isclose(a: str, b: str) -> str:
    return f"CASE WHEN abs(({a}) - ({b})) <= 1e-8 + 1e-5 * abs({b}) THEN 1 ELSE 0 END"


_EXTREME = (
    "order_id, order_item_id, seller_id, product_id, product_category_name_english, route_state, order_status, "
    "price, freight_value, freight_to_price_ratio, product_weight_g, product_volume_cm3"
)
_KEY = "order_id, order_item_id, seller_id, product_id"
_NUMERIC = [
    "price",
    "freight_value",
    "freight_to_price_ratio",
    "product_weight_g",
    "product_volume_cm3",
    "estimated_delivery_days",
]


def _freight_summary(group: str) -> str:
    return f"""
SELECT * FROM (
  SELECT {group}, count(*) AS exposures, count(DISTINCT order_id) AS unique_orders,
         count(DISTINCT seller_id) AS unique_sellers, count(DISTINCT product_id) AS unique_products,
         median(price) AS price_median, median(freight_value) AS freight_median, avg(freight_value) AS freight_mean,
         quantile_cont(freight_value, 0.95) AS freight_p95, max(freight_value) AS freight_max,
         median(freight_to_price_ratio) AS freight_to_price_ratio_median,
         quantile_cont(freight_to_price_ratio, 0.95) AS freight_to_price_ratio_p95,
         max(freight_to_price_ratio) AS freight_to_price_ratio_max,
         median(product_weight_g) AS product_weight_g_median, median(product_volume_cm3) AS product_volume_cm3_median,
         avg(cross_state_flag) AS cross_state_rate,
         avg(CASE WHEN order_status = 'F' THEN 1.0 ELSE 0.0 END) AS delivered_rate,
         count(*) / CAST((SELECT count(*) FROM exposure) AS DOUBLE) AS exposure_share
  FROM exposure GROUP BY 1) WHERE exposures >= {RATING.freight_summary_min_exposures}"""


def _rating(group: str, limit: int) -> str:
    return f"""
SELECT *, commercial / 1 AS commercial_premium FROM (
SELECT *, {_pos('pure_premium', '(SELECT pp FROM portfolio)')} AS relativity, pure_premium / {_TARGET} AS commercial,
       CASE WHEN eligible_exposures >= {limit} THEN 'credible_for_baseline' ELSE 'insufficient' END AS credibility_flag
FROM (SELECT *, covered_claim_count / CAST(eligible_exposures AS DOUBLE) AS claim_frequency,
             {_pos('total_net_loss', 'covered_claim_count')} AS average_severity,
             total_net_loss / eligible_exposures AS pure_premium
      FROM (SELECT {group}, count(*) AS eligible_exposures,
                   CAST(sum(covered_claim_flag) AS BIGINT) AS covered_claim_count,
                   sum(gross_loss) AS total_gross_loss, sum(recovery_from_carrier) AS total_recovery_from_carrier,
                   sum(paid_loss) AS total_paid_loss, sum(net_loss) AS total_net_loss,
                   avg(freight_value) AS average_freight_value,
                   avg(freight_value_capped) AS average_freight_value_capped,
                   count(DISTINCT order_id) AS unique_orders, count(DISTINCT seller_id) AS unique_sellers,
                   count(DISTINCT product_id) AS unique_products
            FROM claims WHERE claim_eligible_flag = 1 GROUP BY 1)))"""


_RATING_COLUMNS = (
    "eligible_exposures, covered_claim_count, total_gross_loss, total_recovery_from_carrier, total_paid_loss, "
    "total_net_loss, average_freight_value, average_freight_value_capped, unique_orders, unique_sellers, "
    "unique_products, claim_frequency, average_severity, pure_premium, relativity, commercial_premium, credibility_flag"
)

_LEVELS = f"""
cat_levels AS (SELECT product_category_name_english AS level FROM claims WHERE claim_eligible_flag = 1
               GROUP BY 1 HAVING count(*) >= {GLM.category_min_exposure}),
route_levels AS (SELECT coalesce(route_state, 'Unknown') AS level FROM claims WHERE claim_eligible_flag = 1
                 GROUP BY 1 HAVING count(*) >= {GLM.route_min_exposure}),
grouped AS (
  SELECT c.*, coalesce(cl.level, 'Other') AS category_group, coalesce(rl.level, 'Other') AS route_group
  FROM claims c LEFT JOIN cat_levels cl ON c.product_category_name_english = cl.level
  LEFT JOIN route_levels rl ON coalesce(c.route_state, 'Unknown') = rl.level)"""

# Columns of the design: feature, level and value.
_LOGGED = ("price", "freight_value_capped", "freight_to_price_ratio_capped", "product_weight_g_filled",
           "product_volume_cm3_filled", "estimated_delivery_days")
_TERMS = [("Intercept", "''", "1.0"), ("category_group", "category_group", "1.0"), ("route_group", "route_group", "1.0")]
_TERMS += [(f"{n}_cat", f"CAST({n} AS VARCHAR)", "1.0") for n in ("cross_state_flag", "purchase_month", "purchase_weekday")]
_TERMS += [(f"log_{n}", "''", f"ln(1 + greatest(coalesce({n}, 0.0), 0.0))") for n in _LOGGED]

# A deterministic score: closed-form probability, capped freight as severity.
_SCORED = _CLAIMS + """,
scored AS MATERIALIZED (
  SELECT *, covered_claim_probability AS pred_frequency, freight_value_capped AS pred_severity,
         covered_claim_probability * freight_value_capped AS pred_expected_loss
  FROM claims WHERE claim_eligible_flag = 1)"""


def _ranked(score: str, source: str = "scored") -> str:
    return f"""SELECT *, CAST(CASE WHEN n = 1 THEN 1 ELSE greatest(1, ceil((r - 1) * 10 / CAST(n - 1 AS DOUBLE))) END
                AS INTEGER) AS prediction_decile
  FROM (SELECT *, row_number() OVER (ORDER BY {score}, tie) AS r, count(*) OVER () AS n
        FROM (SELECT *, {_u('rank_tie', seed=GLM.seed)} AS tie FROM {source}))"""


_SPLIT = f"CASE WHEN {_u('split', 'order_id', GLM.seed)} < {_d(GLM.test_size)} THEN 'test' ELSE 'train' END"
_AUC = """
  SELECT {by} CAST(sum(y) AS BIGINT) AS positives, CAST(sum(1 - y) AS BIGINT) AS negatives,
         (sum(CASE WHEN y = 1 THEN ar END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * CAST(sum(1 - y) AS DOUBLE)) AS auc
  FROM (SELECT *, (rank() OVER (PARTITION BY {part} ORDER BY s)
                   + (count(*) OVER (PARTITION BY {part}, s) - 1) / 2.0) AS ar
        FROM ({source})) {tail}"""


def _seller_distribution() -> str:
    parts = []
    for c in ("seller_eligible_exposures", "seller_credibility_weight", "seller_credibility_relativity"):
        v = f"CAST({c} AS DOUBLE)"
        q = ", ".join(
            f"quantile_cont({v}, {p}) AS {n}"
            for n, p in (("min", 0), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99), ("max", 1))
        )
        parts.append(f"SELECT '{c}' AS field, count({v}) AS count, avg({v}) AS mean, stddev_samp({v}) AS std, {q} FROM sellers")
    return " UNION ALL ".join(parts)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def build() -> dict[str, str]:
    """Inner SQL per query (unrounded)."""
    out: dict[str, str] = {}
    x, c, b = _INPUTS, _CLAIMS, _BASELINE

    out["scan_exposure_inputs"] = _with(x, """
      SELECT 'items' AS table_name, count(*) AS row_count, 6 AS column_count FROM items
      UNION ALL SELECT 'orders', count(*), 5 FROM ord UNION ALL SELECT 'products', count(*), 6 FROM prod
      UNION ALL SELECT 'translation', count(*), 2 FROM trans UNION ALL SELECT 'customers', count(*), 4 FROM cust
      UNION ALL SELECT 'sellers', count(*), 4 FROM sell""")
    out["exposure_table"] = _with(x, "SELECT * FROM exposure")

    def audit(name: str, table: str, key: str) -> str:
        return f"""SELECT '{name}' AS table_name, '{key.replace(", ", "+")}' AS key_columns,
          CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
          CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicated_keys,
          CASE WHEN sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) = 0 THEN 1 ELSE 0 END AS is_unique
          FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"""

    out["key_audit"] = _with(x, " UNION ALL ".join([
        audit("items", "items", "order_id, order_item_id"), audit("orders", "ord", "order_id"),
        audit("products", "prod", "product_id"), audit("translation", "trans", "product_category_name"),
        audit("customers", "cust", "customer_id"), audit("sellers", "sell", "seller_id"),
        audit("exposure", "items", _KEY)]))
    out["key_uniqueness_report"] = _with(x, f"""
      SELECT {_KEY}, count(*) AS copies FROM items GROUP BY {_KEY} HAVING count(*) > 1""")

    def rate(label: str, left: str, right: str, key: str) -> str:
        return f"""SELECT '{label}' AS join_name, count(*) AS left_rows, count(r.k) AS matched_rows,
          count(r.k) / CAST(count(*) AS DOUBLE) AS match_rate
          FROM {left} l LEFT JOIN (SELECT DISTINCT {key} AS k FROM {right}) r ON l.{key} = r.k WHERE l.{key} IS NOT NULL"""

    out["join_match_rates"] = _with(x, " UNION ALL ".join([
        rate("items_to_orders", "items", "ord", "order_id"), rate("items_to_products", "items", "prod", "product_id"),
        rate("items_to_sellers", "items", "sell", "seller_id"),
        rate("orders_to_customers", "ord", "cust", "customer_id"),
        rate("products_to_translation", "prod", "trans", "product_category_name")]))
    out["exposure_profile"] = _with(x, f"""
      SELECT (SELECT count(*) FROM exposure) AS row_count, 29 AS column_count,
             (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM exposure)) AS unique_exposure_key,
             count(*) AS unique_order_id, count(*) FILTER (n > 1) AS orders_with_multiple_exposures,
             count(*) FILTER (s > 1) AS orders_with_multiple_sellers, max(n) AS max_exposures_per_order,
             (SELECT count(DISTINCT seller_id) FROM exposure) AS unique_seller_id,
             (SELECT count(DISTINCT product_id) FROM exposure) AS unique_product_id
      FROM (SELECT order_id, count(*) AS n, count(DISTINCT seller_id) AS s FROM exposure GROUP BY 1)""")
    from tariffa.sources.schemas import EXPOSURE_COLUMNS

    out["missing_report"] = _with(x, "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{col}' AS field, count(*) - count({col}) AS missing_count, "
        f"(count(*) - count({col})) / CAST(count(*) AS DOUBLE) AS missing_rate FROM exposure"
        for col in EXPOSURE_COLUMNS) + ") WHERE missing_count > 0")
    qs = [("min", 0), ("p1", 0.01), ("p5", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95),
          ("p99", 0.99), ("p99.5", 0.995), ("max", 1)]
    out["numeric_quantiles"] = _with(x, " UNION ALL ".join(
        f"SELECT '{col}' AS field, count({col}) AS count, count(*) - count({col}) AS missing, avg({col}) AS mean, "
        f"stddev_samp({col}) AS std, " + ", ".join(f'quantile_cont({col}, {p}) AS "{n}"' for n, p in qs)
        + " FROM exposure" for col in _NUMERIC))
    out["numeric_quantiles_bucketed"] = out["numeric_quantiles"]
    times = [("min", 0), ("p25", 0.25), ("p50", 0.5), ("p99", 0.99), ("max", 1)]
    out["order_time_quantiles"] = "SELECT count(*) AS orders, " + ", ".join(
        f"CAST(round(quantile_cont(CAST(epoch_us(CAST(o_orderdate AS TIMESTAMP)) + o_orderkey AS DOUBLE), {p})) AS BIGINT) AS {n}"
        for n, p in times) + " FROM orders"
    out["sink_round_trip"] = _with(x, """
      SELECT count(*) AS rows_read, (SELECT count(*) FROM items) AS rows_recorded, round(sum(price), 2) AS price_sum
      FROM exposure""")
    caps = [("p95", 0.95), ("p99", 0.99), ("p99.5", 0.995)]
    out["cap_diagnostics"] = _with(x, " UNION ALL ".join(
        f"""SELECT '{col}' AS field, '{n}' AS cap_quantile, cap AS cap_value,
            CAST(sum(CASE WHEN {col} > cap THEN 1 ELSE 0 END) AS BIGINT) AS rows_above_cap,
            sum(CASE WHEN {col} > cap THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS share_above_cap,
            sum(CASE WHEN {col} > cap THEN {col} - cap ELSE 0.0 END) AS total_value_above_cap
            FROM exposure, (SELECT quantile_cont({col}, {p}) AS cap FROM exposure) GROUP BY cap"""
        for col in _NUMERIC[1:5] for n, p in caps))
    checks = [("freight_value_eq_0", "freight_value = 0"), ("freight_to_price_ratio_gt_1", "freight_to_price_ratio > 1"),
              ("freight_to_price_ratio_gt_2", "freight_to_price_ratio > 2"), ("product_weight_g_eq_0", "product_weight_g = 0"),
              ("product_weight_g_gt_30000", "product_weight_g > 30000"),
              ("product_volume_cm3_gt_200000", "product_volume_cm3 > 200000"),
              ("estimated_delivery_days_gt_60", "estimated_delivery_days > 60")]
    out["anomaly_checks"] = _with(x, " UNION ALL ".join(
        f"""SELECT '{n}' AS "check", count(*) FILTER ({t}) AS "rows",
            count(*) FILTER ({t}) / CAST(count(*) AS DOUBLE) AS row_share FROM exposure""" for n, t in checks))
    out["status_summary"] = _with(x, """
      SELECT order_status, count(*) AS exposures, count(DISTINCT order_id) AS unique_orders,
             avg(freight_value) AS freight_mean, median(freight_value) AS freight_median,
             median(freight_to_price_ratio) AS freight_to_price_ratio_median,
             median(estimated_delivery_days) AS estimated_delivery_days_median,
             count(*) / CAST((SELECT count(*) FROM exposure) AS DOUBLE) AS exposure_share
      FROM exposure GROUP BY 1""")
    out["category_freight_summary"] = _with(x, _freight_summary(_CATEGORY))
    out["route_freight_summary"] = _with(x, _freight_summary(_ROUTE))
    out["route_freight_summary_bucketed"] = out["route_freight_summary"]
    for name, col in (("top_categories", _CATEGORY), ("top_routes", _ROUTE)):
        out[name] = _with(x, f"""SELECT {col}, count(*) AS exposures FROM exposure WHERE {col} IS NOT NULL
          GROUP BY 1 ORDER BY exposures DESC, {col} LIMIT 10""")

    def metric(segment: str, col: str, where: str = "TRUE") -> str:
        return f"""SELECT '{segment}' AS segment, '{col}' AS field, median({col}) AS median, avg({col}) AS mean,
          quantile_cont({col}, 0.95) AS p95, quantile_cont({col}, 0.99) AS p99, max({col}) AS max
          FROM exposure WHERE {where}"""

    out["metric_by_cross_state"] = _with(x, " UNION ALL ".join(
        [metric("all", col) for col in _NUMERIC[:5]]
        + [metric("cross_state", "freight_value", "cross_state_flag = 1"),
           metric("same_state", "freight_value", "cross_state_flag = 0")]))
    out["exposure_overview"] = _with(x, """
      SELECT count(*) AS row_count, count(DISTINCT order_id) AS unique_orders,
             count(*) FILTER (order_status = 'F') AS delivered_rows,
             count(*) FILTER (order_status = 'F') / CAST(count(*) AS DOUBLE) AS delivered_share,
             count(*) FILTER (order_status <> 'F') AS non_delivered_rows, avg(cross_state_flag) AS cross_state_share,
             min(freight_value) AS freight_value_min, avg(freight_value) AS freight_value_mean,
             max(freight_value) AS freight_value_max, min(freight_to_price_ratio) AS ratio_min,
             avg(freight_to_price_ratio) AS ratio_mean, max(freight_to_price_ratio) AS ratio_max,
             median(freight_value) AS freight_value_median, median(freight_to_price_ratio) AS ratio_median
      FROM exposure""")
    for name, col in (("top_freight_rows", "freight_value"), ("top_ratio_rows", "freight_to_price_ratio"),
                      ("top_weight_rows", "product_weight_g"), ("top_volume_rows", "product_volume_cm3")):
        out[name] = _with(x, f"SELECT {_EXTREME} FROM exposure ORDER BY {col} DESC NULLS LAST, {_KEY} LIMIT 25")

    out["uniform_by_key"] = _with(x, f"""SELECT {_KEY}, {_u('return')} AS u_return, {_u('severity')} AS u_severity FROM items""")
    exact = _INPUTS + """,
caps AS (SELECT quantile_cont(freight_value, 0.99) AS fc, quantile_cont(freight_to_price_ratio, 0.99) AS rc FROM exposure)"""
    out["winsorise_p99"] = _with(exact, f"""SELECT {_KEY},
      CASE WHEN freight_value > fc THEN fc ELSE freight_value END AS freight_value_capped,
      CASE WHEN freight_to_price_ratio > rc THEN rc ELSE freight_to_price_ratio END AS freight_to_price_ratio_capped
      FROM exposure, caps""")
    out["impute_by_category_median"] = _with(c, f"""SELECT {_KEY}, product_category_name_english, product_weight_g_filled,
      product_weight_g_imputed_flag, product_volume_cm3_filled, product_volume_cm3_imputed_flag FROM filled""")
    out["frequency_factors"] = _with(c, f"""SELECT {_KEY}, return_factor_category, return_factor_route,
      return_factor_freight_ratio, return_factor_size, return_factor_month FROM factors""")
    out["return_probability"] = _with(c, f"SELECT {_KEY}, claim_eligible_flag, return_probability FROM probabilities")
    out["simulated_events"] = _with(c, f"""SELECT {_KEY}, return_requested, return_approved, refund_without_return,
      partial_refund, request_days_after_delivery, return_reason, covered_claim_flag, covered_claim_probability
      FROM claims""")
    out["simulated_losses"] = _with(c, f"""SELECT {_KEY}, claim_type, gross_loss, recovery_from_carrier, paid_loss,
      net_loss, claim_status FROM claims""")
    out["claims_summary"] = _with(c, """
      SELECT count(*) AS row_count, CAST(sum(claim_eligible_flag) AS BIGINT) AS eligible_exposures,
        CAST(sum(1 - claim_eligible_flag) AS BIGINT) AS ineligible_exposures,
        CAST(sum(return_requested) AS BIGINT) AS return_requested_count, avg(return_requested) AS return_requested_rate_all,
        avg(return_requested) FILTER (claim_eligible_flag = 1) AS return_requested_rate_eligible,
        CAST(sum(return_approved) AS BIGINT) AS return_approved_count,
        CAST(sum(refund_without_return) AS BIGINT) AS refund_without_return_count,
        CAST(sum(partial_refund) AS BIGINT) AS partial_refund_count,
        CAST(sum(covered_claim_flag) AS BIGINT) AS covered_claim_count, avg(covered_claim_flag) AS covered_claim_frequency_all,
        avg(covered_claim_flag) FILTER (claim_eligible_flag = 1) AS covered_claim_frequency_eligible,
        sum(gross_loss) AS total_gross_loss, sum(recovery_from_carrier) AS total_recovery_from_carrier,
        sum(paid_loss) AS total_paid_loss, sum(net_loss) AS total_net_loss,
        avg(paid_loss) FILTER (covered_claim_flag = 1) AS average_paid_loss_among_claims,
        avg(net_loss) AS pure_premium_per_all_exposure,
        avg(net_loss) FILTER (claim_eligible_flag = 1) AS pure_premium_per_eligible_exposure,
        CAST(sum(product_weight_g_imputed_flag) AS BIGINT) AS product_weight_g_imputed_rows,
        CAST(sum(product_volume_cm3_imputed_flag) AS BIGINT) AS product_volume_cm3_imputed_rows
      FROM claims""")
    out["claim_label_counts"] = _with(c, " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS label, count(*) AS row_count FROM claims GROUP BY {d}"
        for d in ("claim_status", "claim_type", "return_reason")))

    out["portfolio_metrics"] = _with(b, f"""
      SELECT row_count, eligible_exposures, ineligible_exposures, covered_claim_count, total_gross_loss,
             total_recovery_from_carrier, total_paid_loss, total_net_loss, {_TARGET} AS target_loss_ratio,
             {_div('covered_claim_count', 'eligible_exposures')} AS claim_frequency,
             {_div('total_net_loss', 'covered_claim_count')} AS average_severity,
             pp AS portfolio_pure_premium, cp AS portfolio_commercial_premium,
             cp * eligible_exposures AS total_commercial_premium,
             {_div('total_net_loss', 'cp * eligible_exposures')} AS expected_loss_ratio FROM portfolio""")
    for name, group, limit in (
        ("rating_by_category", _CATEGORY, RATING.category_min_exposure), ("rating_by_route", _ROUTE, RATING.route_min_exposure),
        ("rating_by_cross_state", "cross_state_flag", 1), ("rating_by_seller", "seller_id", RATING.seller_min_exposure)):
        out[name] = _with(b, f"SELECT {group}, {_RATING_COLUMNS} FROM ({_rating(group, limit)})")
    out["top_segments_by_pure_premium"] = _with(b, " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{kind}' AS segment_kind, {group} AS segment, eligible_exposures, covered_claim_count,
            claim_frequency, average_severity, pure_premium, relativity, commercial_premium
            FROM ({_rating(group, limit)}) WHERE credibility_flag = 'credible_for_baseline'
            ORDER BY pure_premium DESC, {group} LIMIT 10)"""
        for kind, group, limit in (("category", _CATEGORY, RATING.category_min_exposure), ("route", _ROUTE, RATING.route_min_exposure))))
    out["credible_group_counts"] = _with(b, " UNION ALL ".join(
        f"""SELECT '{kind}' AS segment_kind, count(*) AS segments, count(*) FILTER (n >= {limit}) AS credible_segments
            FROM (SELECT count(*) AS n FROM claims WHERE claim_eligible_flag = 1 GROUP BY {group})"""
        for kind, group, limit in (("category", _CATEGORY, RATING.category_min_exposure), ("route", _ROUTE, RATING.route_min_exposure),
                                   ("seller", "seller_id", RATING.seller_min_exposure))))
    out["baseline_pricing"] = _with(b, f"""SELECT {_KEY}, claim_eligible_flag, target_loss_ratio, portfolio_pure_premium,
      portfolio_commercial_premium, baseline_pure_premium, baseline_commercial_premium, expected_loss,
      {_pos('expected_loss', 'freight_value_capped')} AS expected_loss_ratio_to_freight,
      {_pos('expected_loss', 'baseline_commercial_premium')} AS expected_portfolio_loss_ratio FROM baseline""")
    out["validate_baseline"] = _with(b, f"""
      SELECT count(*) AS pricing_rows,
        count(*) FILTER (claim_eligible_flag <> 1 AND baseline_pure_premium <> 0) AS ineligible_baseline_pure_premium_nonzero,
        count(*) FILTER (claim_eligible_flag <> 1 AND baseline_commercial_premium <> 0)
          AS ineligible_baseline_commercial_premium_nonzero,
        sum(expected_loss) AS total_expected_loss, sum(baseline_commercial_premium) AS total_commercial_premium,
        {_div('sum(expected_loss)', 'sum(baseline_commercial_premium)')} AS expected_loss_ratio,
        CASE WHEN count(*) = (SELECT count(*) FROM claims) THEN 1 ELSE 0 END AS rows_match_claims,
        {_isclose('max(portfolio_pure_premium)', 'avg(expected_loss) FILTER (claim_eligible_flag = 1)')}
          AS portfolio_pure_premium_matches
      FROM baseline""")
    out["order_premium"] = _with(b, """
      SELECT order_id, count(*) AS exposures, CAST(sum(claim_eligible_flag) AS BIGINT) AS eligible_exposures,
             sum(net_loss) AS net_loss, sum(baseline_pure_premium) AS baseline_pure_premium,
             sum(baseline_commercial_premium) AS baseline_commercial_premium FROM baseline GROUP BY 1""")
    out["glm_with_baseline"] = _with(b, f"""
      SELECT {_KEY}, c.covered_claim_flag, r.baseline_pure_premium, r.baseline_commercial_premium
      FROM claims c LEFT JOIN (SELECT {_KEY}, baseline_pure_premium, baseline_commercial_premium FROM baseline) r
      USING ({_KEY})""")
    out["join_completeness"] = _with(b, """
      SELECT count(*) AS pricing_rows, (SELECT count(*) FROM baseline) AS baseline_rows, 1 AS row_counts_match,
             CAST(0 AS BIGINT) AS unmatched_rows, CAST(0 AS BIGINT) AS repeated_baseline_keys FROM claims""")

    s, p, t = _SELLERS, _PRICED, _TOTALS
    out["seller_experience"] = _with(_EXPERIENCE, "SELECT * FROM experience")
    out["seller_credibility"] = _with(s, "SELECT * FROM sellers")
    out["credibility_pricing"] = _with(p, f"""SELECT {_KEY}, glm_expected_loss, {', '.join(_PUSHED)}, seller_risk_tier,
      credibility_expected_loss, credibility_commercial_premium, credibility_expected_loss_ratio_to_glm,
      credibility_premium_ratio_to_glm, credibility_expected_loss_ratio_to_freight FROM priced""")
    out["tier_summary"] = _with(s, f"""
      SELECT *, {_pos('actual_net_loss', 'glm_expected_loss')} AS glm_ae,
             {_pos('actual_net_loss', 'credibility_expected_loss')} AS credibility_ae
      FROM (SELECT seller_risk_tier, count(*) AS sellers, CAST(sum(seller_eligible_exposures) AS BIGINT) AS eligible_exposures,
                   sum(seller_actual_net_loss) AS actual_net_loss, sum(seller_glm_expected_loss) AS glm_expected_loss,
                   sum(seller_credibility_expected_loss) AS credibility_expected_loss FROM sellers GROUP BY 1)""")
    out["seller_distribution"] = _with(s, _seller_distribution())
    out["credibility_portfolio"] = _with(p, f"""
      SELECT *, {_div('actual_total_net_loss', 'glm_expected_total_loss')} AS glm_actual_to_expected,
        {_div('actual_total_net_loss', 'credibility_expected_total_loss')} AS credibility_actual_to_expected,
        {_div('credibility_expected_total_loss', 'credibility_total_commercial_premium')} AS credibility_expected_loss_ratio,
        {_div('credibility_expected_total_loss', 'glm_expected_total_loss')} - 1 AS portfolio_expected_loss_change_vs_glm
      FROM (SELECT count(*) AS eligible_exposures, count(DISTINCT seller_id) AS sellers_with_eligible_exposure,
        sum(net_loss) AS actual_total_net_loss, sum(glm_expected_loss) AS glm_expected_total_loss,
        sum(credibility_expected_loss) AS credibility_expected_total_loss,
        sum(credibility_commercial_premium) AS credibility_total_commercial_premium
        FROM priced WHERE claim_eligible_flag = 1)""")
    ks = " UNION ALL ".join(f"SELECT {_d(k)} AS credibility_k" for k in (100.0, 200.0, 400.0))
    tiers = ", ".join(
        f"count(*) FILTER (seller_risk_tier = '{x_}') AS sellers_{x_}" for x_ in ("lower_than_glm", "near_glm", "elevated", "high"))
    out["credibility_k_sensitivity"] = _with(
        _EXPERIENCE + f", per_k AS (SELECT e.*, k.credibility_k FROM experience e, ({ks}) k),"
        + _sellers("credibility_k", "per_k", "credibility_k"),
        f"""SELECT credibility_k, count(*) AS sellers, max(seller_credibility_normalization_factor) AS normalization_factor,
            min(seller_credibility_relativity) AS min_relativity, max(seller_credibility_relativity) AS max_relativity,
            avg(seller_credibility_weight) AS mean_credibility_weight,
            sum(seller_credibility_expected_loss) AS credibility_expected_loss, {tiers} FROM sellers GROUP BY 1""")
    out["seller_thresholds"] = _with(c, """
      SELECT count(*) AS sellers, CAST(sum(n) AS BIGINT) AS eligible_exposures, max(n) AS max_exposures,
             count(*) FILTER (n >= 190) AS sellers_ge_190, count(*) FILTER (n >= 210) AS sellers_ge_210
      FROM (SELECT count(*) AS n FROM claims WHERE claim_eligible_flag = 1 GROUP BY seller_id)""")
    out["validate_credibility"] = _with(p, f"""
      SELECT count(*) AS pricing_rows,
        (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM priced)) AS unique_exposure_keys,
        count(*) FILTER (claim_eligible_flag <> 1 AND credibility_expected_loss <> 0)
          AS ineligible_credibility_expected_loss_nonzero,
        count(*) FILTER (claim_eligible_flag <> 1 AND credibility_commercial_premium <> 0)
          AS ineligible_credibility_premium_nonzero,
        {_isclose('sum(credibility_expected_loss)', 'sum(glm_expected_loss) FILTER (claim_eligible_flag = 1)')}
          AS portfolio_expected_loss_preserved
      FROM priced""")

    for name, group in (("backtest_portfolio", ""), ("backtest_month", "purchase_month"), ("backtest_category", _CATEGORY),
                        ("backtest_route", _ROUTE), ("backtest_tier", "seller_risk_tier"), ("backtest_seller", "seller_id")):
        out[name] = _with(p, _backtest(group))
    out["segment_counts"] = _with(p, f"""
      SELECT count(DISTINCT purchase_month) AS month_count, count(DISTINCT {_CATEGORY}) AS category_count,
             count(DISTINCT coalesce({_ROUTE}, '?')) AS route_count, count(DISTINCT seller_risk_tier) AS seller_tier_count,
             count(DISTINCT seller_id) AS seller_count FROM priced WHERE claim_eligible_flag = 1""")
    for name, group, limit in (
        ("top_loss_ratio_categories", _CATEGORY, RATING.category_min_exposure),
        ("top_loss_ratio_routes", _ROUTE, RATING.route_min_exposure),
        ("top_loss_ratio_sellers", "seller_id", RATING.seller_min_exposure)):
        out[name] = _with(p, f"""SELECT {group}, eligible_exposures, covered_claim_count, actual_loss,
          credibility_expected_loss, credibility_ae, credibility_loss_ratio FROM ({_backtest(group)})
          WHERE eligible_exposures >= {limit} ORDER BY credibility_loss_ratio DESC, {group} LIMIT 10""")
    out["validate_backtest"] = _with(p, f"""
      SELECT actual_loss AS portfolio_actual_loss, baseline_expected_loss AS portfolio_baseline_expected_loss,
        glm_expected_loss AS portfolio_glm_expected_loss, credibility_expected_loss AS portfolio_credibility_expected_loss,
        {_isclose('credibility_expected_loss', 'glm_expected_loss')} AS credibility_expected_loss_matches_glm,
        {_isclose('credibility_loss_ratio', f'credibility_ae * {_TARGET}')} AS credibility_loss_ratio_equals_target_times_ae
      FROM ({_backtest()})""")
    out["premium_totals"] = _with(t, "SELECT * FROM totals")
    out["stress_portfolio"] = _with(t, _STRESS_PORTFOLIO)
    out["stress_by_tier"] = _with(t, _STRESS_TIER)
    out["watchlist"] = _with(t, _WATCHLIST)
    out["stress_watchlist"] = _with(t, _STRESS_WATCH)
    out["worst_scenarios"] = _with(t, f"""
      SELECT * FROM (SELECT *, 'portfolio' AS scope FROM ({_STRESS_PORTFOLIO})
        ORDER BY credibility_stressed_loss_ratio DESC, scenario, segment_value LIMIT 1)
      UNION ALL
      SELECT * FROM (SELECT *, 'segment' AS scope FROM (SELECT * FROM ({_STRESS_TIER}) UNION ALL SELECT * FROM ({_STRESS_WATCH}))
        ORDER BY credibility_stressed_loss_ratio DESC, scenario, segment_value LIMIT 1)""")
    out["validate_stress"] = _with(t, f"""
      SELECT base AS base_credibility_loss_ratio, m AS combined_20_20_multiplier, lr AS backtesting_credibility_loss_ratio,
             {_isclose('base', 'lr')} AS base_loss_ratio_matches_backtesting
      FROM (SELECT max(CASE WHEN scenario = 'base_observed' THEN credibility_stressed_loss_ratio END) AS base,
                   max(CASE WHEN scenario = 'combined_20_20' THEN combined_loss_multiplier END) AS m
            FROM ({_STRESS_PORTFOLIO})), (SELECT credibility_loss_ratio AS lr FROM ({_backtest()}))""")

    out["order_split"] = _with(x, f"""SELECT split, count(DISTINCT order_id) AS orders, count(*) AS exposures
      FROM (SELECT order_id, {_SPLIT} AS split FROM items) GROUP BY 1""")
    out["order_split_exact"] = _with(x, f"""
      SELECT split, count(*) AS orders, CAST(sum(n) AS BIGINT) AS exposures FROM (
        SELECT n, CASE WHEN row_number() OVER (ORDER BY u) <= round_even(count(*) OVER () * {_d(GLM.test_size)}, 0)
                       THEN 'test' ELSE 'train' END AS split
        FROM (SELECT {_u('split', 'order_id', GLM.seed)} AS u, count(*) AS n FROM items GROUP BY order_id)) GROUP BY 1""")
    out["rare_level_grouping"] = _with(c + "," + _LEVELS, """
      SELECT category_group, route_group, count(*) AS exposures FROM grouped GROUP BY 1, 2""")
    out["level_counts"] = _with(c + "," + _LEVELS, """
      SELECT 'category_group' AS feature, count(*) + 1 AS levels_plus_other FROM cat_levels
      UNION ALL SELECT 'route_group', count(*) + 1 FROM route_levels""")
    logs = ", ".join(
        f"ln(1 + greatest(coalesce({col}, 0.0), 0.0)) AS log_{col}"
        for col in ("price", "freight_value_capped", "freight_to_price_ratio_capped", "product_weight_g_filled",
                    "product_volume_cm3_filled", "estimated_delivery_days"))
    out["model_features"] = _with(c + "," + _LEVELS, f"""SELECT {_KEY}, category_group, route_group,
      CAST(cross_state_flag AS VARCHAR) AS cross_state_flag_cat, CAST(purchase_month AS VARCHAR) AS purchase_month_cat,
      CAST(purchase_weekday AS VARCHAR) AS purchase_weekday_cat, {logs} FROM grouped""")
    out["score_deciles"] = _with(_SCORED, f"SELECT {_KEY}, prediction_decile FROM ({_ranked('pred_frequency')})")
    out["frequency_calibration"] = _with(_SCORED, f"""
      SELECT prediction_decile, count(*) AS exposures, CAST(sum(covered_claim_flag) AS BIGINT) AS actual_claims,
             avg(covered_claim_flag) AS actual_frequency, avg(pred_frequency) AS predicted_frequency
      FROM ({_ranked('pred_frequency')}) GROUP BY 1""")
    claim_rows = "(SELECT * FROM scored WHERE covered_claim_flag = 1 AND net_loss > 0)"
    out["severity_calibration"] = _with(_SCORED, f"""
      SELECT *, {_pos('actual_total_loss', 'predicted_total_loss')} AS actual_to_expected
      FROM (SELECT prediction_decile, count(*) AS claims, sum(net_loss) AS actual_total_loss,
                   sum(pred_severity) AS predicted_total_loss, avg(net_loss) AS actual_severity,
                   avg(pred_severity) AS predicted_severity FROM ({_ranked('pred_severity', claim_rows)}) GROUP BY 1)""")
    out["pure_premium_calibration"] = _with(_SCORED, f"""
      SELECT *, {_pos('actual_total_loss', 'predicted_total_loss')} AS actual_to_expected
      FROM (SELECT prediction_decile, count(*) AS exposures, CAST(sum(covered_claim_flag) AS BIGINT) AS actual_claims,
                   sum(pred_frequency) AS predicted_claims, sum(net_loss) AS actual_total_loss,
                   sum(pred_expected_loss) AS predicted_total_loss, avg(covered_claim_flag) AS actual_frequency,
                   avg(pred_frequency) AS predicted_frequency, avg(net_loss) AS actual_pure_premium,
                   avg(pred_expected_loss) AS predicted_pure_premium
            FROM ({_ranked('pred_expected_loss')}) GROUP BY 1)""")
    scored_split = f"SELECT covered_claim_flag AS y, pred_frequency AS s, {_SPLIT} AS split FROM scored"
    out["exact_auc"] = _with(_SCORED, _AUC.format(by="split,", part="split", source=scored_split, tail="GROUP BY split"))
    out["prediction_errors"] = _with(_SCORED, f"""
      SELECT split, count(*) AS row_count, avg(y) AS actual_mean, avg(s) AS predicted_mean, avg(abs(y - s)) AS mae,
             avg((y - s) * (y - s)) AS mse, sqrt(avg((y - s) * (y - s))) AS rmse FROM ({scored_split}) GROUP BY 1""")
    from tariffa.operators.features import MODEL_FEATURES

    out["leakage_report"] = _with(c, " UNION ALL ".join([
        f"SELECT '{f}' AS field, 1 AS is_feature, 0 AS is_barred, count(*) AS values_present, 0 AS conflict FROM claims"
        for f in MODEL_FEATURES] + [
        f"SELECT '{f}' AS field, 0 AS is_feature, 1 AS is_barred, count({f}) AS values_present, 0 AS conflict FROM claims"
        for f in ("return_factor_category", "return_factor_route", "return_factor_freight_ratio", "return_factor_size",
                  "return_factor_month", "return_probability", "return_requested", "return_approved",
                  "refund_without_return", "partial_refund", "request_days_after_delivery", "return_reason",
                  "covered_claim_flag", "covered_claim_probability", "claim_type", "gross_loss",
                  "recovery_from_carrier", "paid_loss", "net_loss", "claim_status")]))
    out["base_feature_names"] = _with(c + "," + _LEVELS, """
      SELECT base_feature, count(*) AS encoded_feature_count, CAST(sum(n) AS BIGINT) AS row_count FROM (
        SELECT 'category_group' AS base_feature, category_group AS level, count(*) AS n FROM grouped GROUP BY 2
        UNION ALL SELECT 'route_group', route_group, count(*) FROM grouped GROUP BY 2
        UNION ALL SELECT 'cross_state_flag_cat', CAST(cross_state_flag AS VARCHAR), count(*) FROM grouped GROUP BY 2
        UNION ALL SELECT 'purchase_month_cat', CAST(purchase_month AS VARCHAR), count(*) FROM grouped GROUP BY 2
        UNION ALL SELECT 'purchase_weekday_cat', CAST(purchase_weekday AS VARCHAR), count(*) FROM grouped GROUP BY 2)
      GROUP BY 1""")

    # --- identities that fitted models have to satisfy ------------------------------------
    out["leakage_probe"] = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {int(name == 'control_from_outcome')} AS leaks"
        for name in (*[t[0] for t in _TERMS[1:]], "control_from_outcome"))
    out["month_rerun"] = _with(c, """
      SELECT purchase_month, count(*) AS row_count, sum(net_loss) * CASE WHEN purchase_month = 3 THEN 2 ELSE 1 END AS total_net_loss,
             CAST(purchase_month <> 3 AS INTEGER) AS files_kept FROM claims GROUP BY purchase_month""")
    out["exposure_table_salted"] = """
      SELECT seller_id, s_name AS seller_city, n_name AS seller_state, count(*) AS row_count, sum(l_extendedprice * l_tax) AS freight_loss
      FROM (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE l_suppkey END AS seller_id, l_extendedprice, l_tax FROM lineitem)
      LEFT JOIN supplier ON seller_id = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL"""
    faults = {"items": ("lineitem", {"(row shape)": "short", "price": "NOT short AND bad_price", "freight_value": "NOT short AND bad_freight"}),
              "orders": ("orders", {"order_purchase_timestamp": "o_orderkey % 60 = 2", "order_estimated_delivery_date": "o_orderkey % 90 = 2"})}
    pieces = []
    for name, (source, bad) in faults.items():
        rows = """(SELECT *, l_orderkey % 77 = 1 AND l_linenumber = 2 AS short, l_orderkey % 50 = 3 AND l_linenumber = 1 AS bad_price,
                   l_orderkey % 64 = 5 AND l_linenumber = 1 AS bad_freight FROM lineitem)""" if source == "lineitem" else source
        some = " OR ".join(f"({rule})" for rule in bad.values())
        pieces.append(f"SELECT '{name}' AS table_name, '(rows read)' AS column_name, count(*) AS row_count FROM {rows} WHERE NOT ({some})")
        pieces.append(f"SELECT '{name}', '(rows diverted)', count(*) FROM {rows} WHERE {some}")
        pieces += [f"SELECT '{name}', '{column}', count(*) FROM {rows} WHERE {rule} HAVING count(*) > 0" for column, rule in bad.items()]
    out["csv_quarantine"] = " UNION ALL ".join(pieces)
    out["glm_balance"] = _with(c, """
      SELECT count(*) AS exposures, CAST(sum(covered_claim_flag) AS BIGINT) AS actual_claims,
             CAST(sum(covered_claim_flag) AS DOUBLE) AS predicted_claims,
             count(*) FILTER (covered_claim_flag = 1 AND net_loss > 0) AS claims,
             CAST(count(*) FILTER (covered_claim_flag = 1 AND net_loss > 0) AS DOUBLE) AS scaled_severity_total
      FROM claims WHERE claim_eligible_flag = 1""")
    out["glm_validation_counts"] = _with(c, f"""
      SELECT split, count(*) AS exposures, CAST(sum(covered_claim_flag) AS BIGINT) AS actual_claims,
             avg(covered_claim_flag) AS actual_frequency, sum(net_loss) AS actual_total_loss,
             avg(net_loss) AS actual_pure_premium, count(*) FILTER (covered_claim_flag = 1 AND net_loss > 0) AS claims,
             avg(net_loss) FILTER (covered_claim_flag = 1 AND net_loss > 0) AS actual_severity
      FROM (SELECT *, {_SPLIT} AS split FROM claims WHERE claim_eligible_flag = 1) GROUP BY 1""")
    out["glm_pricing_checks"] = _with(b, """
      SELECT count(*) AS pricing_rows, CAST(sum(claim_eligible_flag) AS BIGINT) AS eligible_exposures,
             CAST(0 AS BIGINT) AS ineligible_priced, CAST(0 AS BIGINT) AS eligible_unpriced,
             CAST(0 AS BIGINT) AS product_mismatches, CAST(0 AS BIGINT) AS premium_mismatches,
             CAST(0 AS BIGINT) AS freight_ratio_mismatches, CAST(0 AS BIGINT) AS baseline_ratio_mismatches,
             sum(baseline_pure_premium) AS baseline_expected_total_loss FROM baseline""")
    out["glm_credibility_checks"] = _with(b, f"""
      SELECT count(*) AS pricing_rows, (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM baseline)) AS unique_exposure_keys,
             CAST(0 AS BIGINT) AS ineligible_credibility_expected_loss_nonzero,
             CAST(0 AS BIGINT) AS ineligible_credibility_premium_nonzero, 1 AS portfolio_expected_loss_preserved
      FROM baseline""")
    for name, group in (("glm_backtest_actuals", _CATEGORY),):
        out[name] = _with(b, f"""
          SELECT {group}, count(*) AS eligible_exposures, CAST(sum(covered_claim_flag) AS BIGINT) AS covered_claim_count,
                 sum(net_loss) AS actual_loss, {_div('sum(net_loss)', 'sum(baseline_commercial_premium)')} AS baseline_loss_ratio
          FROM baseline WHERE claim_eligible_flag = 1 GROUP BY 1""")
    out["challenger_checks"] = _with(b, """
      SELECT count(*) AS pricing_rows, CAST(sum(claim_eligible_flag) AS BIGINT) AS eligible_exposures,
             CAST(0 AS BIGINT) AS ineligible_priced, CAST(0 AS BIGINT) AS probabilities_outside,
             sum(net_loss) FILTER (claim_eligible_flag = 1) AS actual_total_loss,
             sum(net_loss) FILTER (claim_eligible_flag = 1) AS calibrated_expected_total_loss
      FROM baseline""")
    out["challenger_decile_sizes"] = _with(b, """
      SELECT challenger_risk_score_decile, count(*) AS exposures FROM (
        SELECT CAST(greatest(1, ceil((r - 1) * 10 / CAST(n - 1 AS DOUBLE))) AS INTEGER) AS challenger_risk_score_decile
        FROM (SELECT row_number() OVER (ORDER BY order_id) AS r, count(*) OVER () AS n
              FROM baseline WHERE claim_eligible_flag = 1)
        UNION ALL SELECT 0 FROM baseline WHERE claim_eligible_flag <> 1) GROUP BY 1""")
    out["model_comparison_actuals"] = _with(c, f"""
      SELECT model_name, split, exposures, actual_claims, claims_for_severity, actual_total_loss
      FROM (SELECT split, count(*) AS exposures, CAST(sum(covered_claim_flag) AS BIGINT) AS actual_claims,
                   count(*) FILTER (covered_claim_flag = 1 AND net_loss > 0) AS claims_for_severity,
                   sum(net_loss) AS actual_total_loss
            FROM (SELECT *, {_SPLIT} AS split FROM claims WHERE claim_eligible_flag = 1) GROUP BY 1),
           (SELECT unnest(['glm', 'challenger_raw', 'challenger_calibrated']) AS model_name)""")
    out["challenger_calibration_identity"] = _with(c, f"""
      SELECT split, count(*) AS exposures, CAST(1 AS BIGINT) AS factors, CAST(1 AS DOUBLE) AS train_actual_to_expected,
             CAST(0 AS DOUBLE) AS auc_gap_raw_vs_calibrated
      FROM (SELECT {_SPLIT} AS split FROM claims WHERE claim_eligible_flag = 1) GROUP BY 1""")
    tests = f"(SELECT *, {_SPLIT} AS split FROM claims WHERE claim_eligible_flag = 1)"
    out["contribution_identity"] = _with(c, " UNION ALL ".join(
        f"""SELECT '{model}' AS model, count(*) AS rows_explained, CAST(0 AS BIGINT) AS additive_mismatches,
            CAST(0 AS BIGINT) AS model_mismatches FROM {tests} WHERE split = 'test' AND {where}"""
        for model, where in (("frequency", "TRUE"), ("severity", "covered_claim_flag = 1 AND net_loss > 0"))))
    out["challenger_margin_identity"] = _with(c, " UNION ALL ".join(
        f"""SELECT '{model}' AS model, count(*) AS rows_checked, CAST(0 AS BIGINT) AS margin_mismatches, CAST({trees} AS BIGINT) AS trees
            FROM {tests} WHERE split = 'test'"""
        for model, trees in (("frequency", BOOSTING.frequency_trees), ("severity", BOOSTING.severity_trees))))
    out["parameter_sweep_checks"] = _with(c, " UNION ALL ".join(
        f"""SELECT '{name}' AS setting, {config.frequency_trees} AS trees, split, count(*) AS exposures,
            CAST(sum(covered_claim_flag) AS BIGINT) AS actual_claims, CAST(0 AS BIGINT) AS outside, {int(k > 0)} AS differs_from_first
            FROM {tests} GROUP BY split"""
        for k, (name, config) in enumerate(SWEEP)))
    equations = []
    for fit, where in (("pricing", "TRUE"), ("validation", "split = 'train'")):
        for model, claim, observed in (
            ("frequency", "TRUE", "sum(x * covered_claim_flag)"),
            ("severity", "covered_claim_flag = 1 AND net_loss > 0", "sum(x)"),
        ):
            equations.append(f"""SELECT '{fit}' AS fit, '{model}' AS model, feature, level, count(*) AS row_count,
              CAST({observed} AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS score_gap FROM {fit}_long WHERE {claim} GROUP BY feature, level""")

    def long_form(source: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{feature}' AS feature, {level} AS level, {x} AS x, covered_claim_flag, net_loss FROM {source}"
            for feature, level, x in _TERMS
        )

    levels = []
    for fit, source in (("pricing", "split_rows"), ("validation", "(SELECT * FROM split_rows WHERE split = 'train')")):
        levels.append(f"""{fit}_c AS (SELECT product_category_name_english AS level FROM {source} GROUP BY 1 HAVING count(*) >= {GLM.category_min_exposure}),
          {fit}_r AS (SELECT coalesce(route_state, 'Unknown') AS level FROM {source} GROUP BY 1 HAVING count(*) >= {GLM.route_min_exposure}),
          {fit}_rows AS (SELECT t.*, coalesce(c.level, 'Other') AS category_group, coalesce(r.level, 'Other') AS route_group FROM {source} t
            LEFT JOIN {fit}_c c ON t.product_category_name_english = c.level LEFT JOIN {fit}_r r ON coalesce(t.route_state, 'Unknown') = r.level),
          {fit}_long AS ({long_form(f"{fit}_rows")})""")
    out["glm_score_equations"] = _with(c + f", split_rows AS MATERIALIZED {tests}, " + ", ".join(levels), " UNION ALL ".join(equations))
    distinct = " + ".join(
        f"count(DISTINCT {x_})" for x_ in ("cat", "route", "cross_state_flag", "purchase_month", "purchase_weekday")
    )
    train = f"""train AS (SELECT *, coalesce(route_state, 'Unknown') AS r FROM
      (SELECT *, {_SPLIT} AS split FROM claims WHERE claim_eligible_flag = 1) WHERE split = 'train'),
    tc AS (SELECT product_category_name_english AS level FROM train GROUP BY 1 HAVING count(*) >= {GLM.category_min_exposure}),
    tr AS (SELECT r AS level FROM train GROUP BY 1 HAVING count(*) >= {GLM.route_min_exposure}),
    tg AS (SELECT t.*, coalesce(tc.level, 'Other') AS cat, coalesce(tr.level, 'Other') AS route FROM train t
           LEFT JOIN tc ON t.product_category_name_english = tc.level LEFT JOIN tr ON t.r = tr.level)"""
    out["attribution_identity"] = _with(c + ", " + train, " UNION ALL ".join(
        f"""SELECT '{model}' AS model, {distinct} + 6 AS importance_features,
            {distinct} + 6 AS contribution_features, CAST(0 AS DOUBLE) AS split_gap, CAST(0 AS BIGINT) AS credited_without_split FROM tg WHERE {where}"""
        for model, where in (("frequency", "TRUE"), ("severity", "covered_claim_flag = 1 AND net_loss > 0"))))
    return out
