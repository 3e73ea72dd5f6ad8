"""Dashboard measures over the clean sales tables.

The reference only promises these on its dashboard; the formulas are ours.
Money is summed exactly as ``decimal(38,2)`` (double sums depend on the order
rows arrive in) and reported as double.  What the measures cannot use (an
amount that is no number of at most 1e36, a time that does not parse) is
counted per branch by :func:`unmeasured_orders`, which the measures job writes
beside them.  Every measure aggregates
first (partial aggregation map-side, so a hot branch or manager is combined
before the shuffle); the windows then run on the small (branch x month) rows,
partitioned by branch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def _money(c: str = "total_amount"):
    return F.col(c).try_cast(MONEY)


def _sales_aggs():
    amt = _money()
    total = F.sum(amt)
    return [F.count(F.lit(1)).alias("n_orders"),
            total.cast("double").alias("total_sales"),
            (total.cast("double") / F.count(amt).cast("double")).alias("avg_sales")]


def total_sales(orders: DataFrame) -> DataFrame:
    """D1m: total sales per currency."""
    return (orders.groupBy("currency_code")
                  .agg(F.sum(_money()).cast("double").alias("total_sales")))


def branch_totals(orders: DataFrame) -> DataFrame:
    """Per branch: orders, exact sales sum and orders with an amount.  The
    base of D2m, D3m, D5m, D8m and D9m: decimal sums add up exactly, so the
    global and ranked measures derive from these few rows without rescanning
    the orders (the measures job writes it once)."""
    amt = _money()
    return orders.groupBy("filial_code").agg(F.count(F.lit(1)).alias("n_orders"),
                                             F.sum(amt).alias("sales"),
                                             F.count(amt).alias("n_amt"))


def _branch(orders: DataFrame, branch: DataFrame | None) -> DataFrame:
    return branch if branch is not None else branch_totals(orders)


def _totals(orders: DataFrame, branch: DataFrame | None) -> DataFrame:
    """Rows to total for a global measure: the per-branch base when given,
    else one row per order with the same columns (one global aggregate, no
    extra level)."""
    if branch is not None:
        return branch
    amt = _money()
    return orders.select(F.lit(1).cast("long").alias("n_orders"), amt.alias("sales"),
                         amt.isNotNull().cast("long").alias("n_amt"))


def average_sales(orders: DataFrame, branch: DataFrame | None = None) -> DataFrame:
    """D2m: average order amount (orders with an amount)."""
    return _totals(orders, branch).agg(
        (F.sum("sales").cast("double") / F.sum("n_amt").cast("double")).alias("avg_sales"))


def total_orders(orders: DataFrame, branch: DataFrame | None = None) -> DataFrame:
    """D3m: number of orders (deal_id is unique after keep-first)."""
    return _totals(orders, branch).agg(F.sum("n_orders").cast("long").alias("n_orders"))


def returned_orders(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """D4m: per branch, orders and orders with at least one return document.

    The returned-order keys are de-duplicated by an aggregate (partial, so a
    heavily returned order collapses map-side) and joined as a semi-join flag;
    no key list ever reaches the driver."""
    returned = (returns.select(F.col("order_deal_id").alias("deal_id"))
                       .where(F.col("deal_id").isNotNull())
                       .groupBy("deal_id").agg(F.lit(1).alias("_returned")))
    flagged = orders.select("filial_code", "deal_id").join(returned, "deal_id", "left")
    return (flagged.groupBy("filial_code")
                   .agg(F.count(F.lit(1)).alias("n_orders"),
                        F.count("_returned").alias("n_returned")))


def sales_by_branch(orders: DataFrame, branch: DataFrame | None = None) -> DataFrame:
    """D5m: order count, total and average sales per branch."""
    b = _branch(orders, branch)
    return b.select("filial_code", "n_orders", F.col("sales").cast("double").alias("total_sales"),
                    (F.col("sales").cast("double") / F.col("n_amt").cast("double"))
                    .alias("avg_sales"))


def sales_by_manager(orders: DataFrame) -> DataFrame:
    """D6m: order count, total and average sales per sales manager."""
    return orders.groupBy("sales_manager_id").agg(*_sales_aggs())


def monthly_branch_sales(orders: DataFrame) -> DataFrame:
    """Branch x month sales (exact decimal) — the base of D7m, D10m–D12m."""
    month = F.date_format(F.try_to_date(F.col("deal_time")), "yyyy-MM")
    return (orders.select("filial_code", month.alias("month"), _money().alias("amt"))
                  .where(F.col("month").isNotNull())
                  .groupBy("filial_code", "month")
                  .agg(F.sum("amt").alias("sales")))


def _monthly(orders: DataFrame, monthly: DataFrame | None) -> DataFrame:
    """The branch x month base: given (computed once and written by the
    measures job) or computed here."""
    return monthly if monthly is not None else monthly_branch_sales(orders)


def _by_branch(frame=None):
    w = Window.partitionBy("filial_code").orderBy("month")
    return w if frame is None else w.rowsBetween(*frame)


def trade_dynamics(orders: DataFrame, monthly: DataFrame | None = None) -> DataFrame:
    """D7m: monthly sales per branch and the change against the previous month."""
    m = _monthly(orders, monthly)
    prev = F.lag("sales").over(_by_branch())
    return m.select("filial_code", "month",
                    F.col("sales").cast("double").alias("sales"),
                    prev.cast("double").alias("prev_sales"),
                    (F.col("sales") - prev).cast("double").alias("change"))


def top_branches(orders: DataFrame, k: int = 10, branch: DataFrame | None = None) -> DataFrame:
    """D8m: the k branches with the highest sales, ranked.  ``orderBy.limit``
    is a per-partition top-k merged at the end; the rank window then runs on
    at most k rows."""
    agg = _branch(orders, branch)
    top = agg.orderBy(F.col("sales").desc_nulls_last(), F.col("filial_code")).limit(k)
    w = Window.orderBy(F.col("sales").desc_nulls_last(), F.col("filial_code"))
    return top.select("filial_code", F.col("sales").cast("double").alias("total_sales"),
                      F.row_number().over(w).cast("long").alias("rank"))


def contribution(orders: DataFrame, branch: DataFrame | None = None) -> DataFrame:
    """D9m: each branch's share of total sales.  The grand total is a scalar
    subquery (one row, computed once and inlined), so no join is needed."""
    agg = _branch(orders, branch)
    # total of the (exact decimal) branch sums: same subtree as `agg`, so the
    # orders pipeline and its shuffles are shared instead of run twice
    grand = agg.agg(F.sum("sales").cast("double").alias("grand")).scalar()
    return agg.select("filial_code", F.col("sales").cast("double").alias("total_sales"),
                      F.try_divide(F.col("sales").cast("double"), grand).alias("share"))


def moving_average(orders: DataFrame, monthly: DataFrame | None = None,
                   months: int = 3) -> DataFrame:
    """D10m: trailing ``months``-month average of monthly sales per branch."""
    m = _monthly(orders, monthly)
    w = _by_branch((-(months - 1), 0))
    return m.select("filial_code", "month", F.col("sales").cast("double").alias("sales"),
                    (F.sum("sales").over(w).cast("double") / F.count("sales").over(w)
                     .cast("double")).alias("moving_avg"))


def cumulative_sales(orders: DataFrame, monthly: DataFrame | None = None) -> DataFrame:
    """D11m: running total of monthly sales per branch."""
    m = _monthly(orders, monthly)
    w = _by_branch((Window.unboundedPreceding, 0))
    return m.select("filial_code", "month", F.col("sales").cast("double").alias("sales"),
                    F.sum("sales").over(w).cast("double").alias("cumulative_sales"))


def sales_anomalies(orders: DataFrame, monthly: DataFrame | None = None,
                    history: int = 6, k: int = 2) -> DataFrame:
    """D12m: months whose sales deviate by more than ``k`` sample standard
    deviations from the branch's previous ``history`` months (needs >= 2).

    Tested exactly on decimals: with n, S = sum, Q = sum of squares over the
    history, |x - S/n| > k*sd  <=>  (n-1)(n x - S)^2 > k^2 n (n Q - S^2).
    In cents, ``decimal(38,0)`` holds this for monthly branch sales up to about
    8e15 currency units.  Where a step does not fit, the same test runs on
    doubles."""
    m = _monthly(orders, monthly).withColumns({
        "x": (F.col("sales") * 100).try_cast("decimal(38,0)"),       # exact cents
        "d": F.col("sales").cast("double")})
    w = _by_branch((-history, -1))
    z = m.select("filial_code", "month", "sales", "x", "d",
                 F.count("sales").over(w).cast("decimal(38,0)").alias("n"),
                 F.try_sum("x").over(w).try_cast("decimal(38,0)").alias("s"),
                 F.try_sum(F.try_multiply("x", "x")).over(w).try_cast("decimal(38,0)").alias("q"),
                 F.count(F.try_multiply("x", "x")).over(w).alias("whole"),
                 F.avg("d").over(w).alias("mean"), F.stddev_samp("d").over(w).alias("sd"))
    n, x = F.col("n"), F.col("x")
    dev = F.try_subtract(F.try_multiply(n, x), F.col("s"))
    left = F.try_multiply(n - 1, F.try_multiply(dev, dev))
    right = F.try_multiply(F.lit(k * k) * n, F.try_subtract(F.try_multiply(n, F.col("q")),
                                                          F.try_multiply("s", "s")))
    exact = F.when(F.col("whole") == n, left > right)
    about = F.abs(F.col("d") - F.col("mean")) > k * F.col("sd")
    return z.where((n >= 2) & F.coalesce(exact, about)).select(
        "filial_code", "month", F.col("sales").cast("double").alias("sales"))


def unmeasured_orders(orders: DataFrame) -> DataFrame:
    """Per branch: orders whose amount is present but cannot be summed (left
    out of every sum, counted in ``n_orders``) and orders whose time does not
    parse (left out of the monthly measures)."""
    amount = F.col("total_amount").isNotNull() & _money().isNull()
    time = F.try_to_date(F.col("deal_time")).isNull()
    return orders.groupBy("filial_code").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(amount).alias("n_amount_unsummable"),
        F.count_if(time).alias("n_time_unparsed"),
        F.sum(F.when(time, _money())).cast("double").alias("sales_time_unparsed"))


# Measures over the per-branch base (accept ``branch=``).
BRANCH_MEASURES = ("d2_average_sales", "d3_total_orders", "d5_sales_by_branch",
                   "d8_top_branches", "d9_contribution")

# Measures over the branch x month base (accept ``monthly=``).
MONTHLY_MEASURES = ("d7_trade_dynamics", "d10_moving_average", "d11_cumulative_sales",
                    "d12_sales_anomalies")

MEASURES = {
    "d1_total_sales": total_sales,
    "d2_average_sales": average_sales,
    "d3_total_orders": total_orders,
    "d4_returned_orders": returned_orders,
    "d5_sales_by_branch": sales_by_branch,
    "d6_sales_by_manager": sales_by_manager,
    "d7_trade_dynamics": trade_dynamics,
    "d8_top_branches": top_branches,
    "d9_contribution": contribution,
    "d10_moving_average": moving_average,
    "d11_cumulative_sales": cumulative_sales,
    "d12_sales_anomalies": sales_anomalies,
    "unmeasured_orders": unmeasured_orders,
}
