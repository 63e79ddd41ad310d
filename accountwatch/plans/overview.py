"""Everything the overview shows, read from the three lane states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwatch.lanes import CHURN, LOOPS, TICKETS
from accountwatch.operators import figures
from accountwatch.operators.keep import latest, pending, ready_for_review


def stored_overview(tickets: DataFrame, loops: DataFrame, churn: DataFrame, path: str) -> DataFrame:
    """Every figure in long form, read from one stored row per account: the lanes are read once."""
    accounts = figures.account_overview(latest(tickets, TICKETS), latest(loops, LOOPS), latest(churn, CHURN))
    accounts.write.mode("overwrite").parquet(path)
    return figures.overview_figures(tickets.sparkSession.read.schema(accounts.schema).parquet(path))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("account_id"), F.lit(buckets)).cast("int")


def start_overview(tickets: DataFrame, loops: DataFrame, churn: DataFrame, path: str, buckets: int = 64) -> None:
    """Stores one row per account, in buckets of accounts, for ``refresh_overview`` to keep up to date."""
    accounts = figures.account_overview(latest(tickets, TICKETS), latest(loops, LOOPS), latest(churn, CHURN))
    rows = accounts.withColumns({"alive": F.lit(True), "bucket": _bucket(buckets)})
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def refresh_overview(tickets: DataFrame, loops: DataFrame, churn: DataFrame, touched: DataFrame, path: str, buckets: int = 64) -> None:
    """Counts the accounts again whose alerts, drafts or approvals have changed; ``touched`` has their account_id.

    Figures are sums over accounts, so replacing an account's row takes out what it
    added before and puts in what it adds now. Only the buckets of touched accounts are
    read and written again; of the lanes, only the rows of touched accounts are aggregated.
    An account without alerts left keeps a row that counts for nothing. A refresh that
    breaks off is repeated with the same accounts.
    """
    spark = touched.sparkSession
    touched = touched.select(F.col("account_id").alias("__account")).distinct()

    def of_touched(rows: DataFrame) -> DataFrame:
        return rows.join(touched, rows["account_id"].eqNullSafe(touched["__account"]), "left_semi")

    views = [latest(of_touched(rows), lane) for rows, lane in ((tickets, TICKETS), (loops, LOOPS), (churn, CHURN))]
    now = figures.account_overview(*views)
    new = touched.join(now, F.col("__account").eqNullSafe(now["account_id"]), "left").withColumns(
        {"account_id": F.col("__account"), "alive": F.col("leading").isNotNull(), "bucket": _bucket(buckets)}
    )
    stored = spark.read.parquet(path)
    hit = [r[0] for r in new.select("bucket").distinct().collect()]
    others = stored.where(F.col("bucket").isin(hit)).join(touched, stored["account_id"].eqNullSafe(touched["__account"]), "left_anti")
    rows = others.unionByName(new.select(*stored.columns)).repartition("bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def current_overview(spark: SparkSession, path: str) -> DataFrame:
    """Every figure in long form from the stored accounts."""
    return figures.overview_figures(spark.read.parquet(path).where("alive"))


def overview(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> dict[str, DataFrame]:
    """Small result tables by name, and the three review lists."""
    views = latest(tickets, TICKETS), latest(loops, LOOPS), latest(churn, CHURN)
    return {
        "kpis": figures.lane_kpis(*views),
        "risk_by_alert_type": figures.risk_by_alert_type(*views),
        "revenue_funnel": figures.revenue_funnel(*views),
        "top_exposed_accounts": figures.top_exposed_accounts(*views),
        "actioned_accounts": figures.actioned_accounts(*views),
        "ticket_counts": figures.alert_counts(views[0]),
        "loop_counts": figures.alert_counts(views[1]),
        "churn_counts": figures.alert_counts(views[2]),
        "ticket_reviews": ready_for_review(views[0]),
        "loop_reviews": pending(views[1]),
        "churn_reviews": pending(views[2]),
    }
