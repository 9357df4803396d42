"""Write-back of results: joins to services, updates, statements, report lines, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenderline import catalog
from tenderline.operators.aggregates import stacked
from tenderline.operators.joins import except_listed, lookup

SURCHARGE_KEYS = ["direction", "feature", "svc_type", "surcharge_type", "package_type", "acquisition"]


def with_prior_results(quotes: DataFrame, prior: DataFrame) -> DataFrame:
    """Product quotes joined to prior results of the same bid and service; surcharges unchanged.

    ``prior`` has svc_group, recommended, low, high and the three service codes.
    """
    surcharge = F.col("mode") == catalog.SURCHARGE_MODE
    renamed = prior.withColumnsRenamed({"recommended": "prior_target", "low": "prior_low", "high": "prior_high"})
    products = quotes.where(~surcharge).join(renamed, ["bid_id", "direction", "svc_type", "feature"])
    for name in ("das", "resi"):
        if name not in products.columns:
            products = products.withColumn(name, F.lit(None).cast("double"))
    products = products.drop(*[c for c in ("surcharge_type", "package_type", "acquisition", "description") if c in products.columns])
    return stacked([products, quotes.where(surcharge)])


def stamped(results: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the minute the results were made."""
    return results.withColumn("scored_at", F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd HH:mm"))


def updates_allowed(bid_id: Column, holdout: DataFrame, rows: DataFrame) -> DataFrame:
    """Keep the switch of the bid's last digit; an unknown digit is on."""
    digit = F.right(bid_id, F.lit(1)).try_cast("int")
    side = holdout.select(F.col("digit").alias("__digit"), F.col("is_on").alias("__on"))
    joined = lookup(rows.withColumn("__digit", digit), side, ["__digit"], "left")
    return joined.withColumn("update_on", F.coalesce("__on", F.lit(True))).drop("__digit", "__on")


def product_updates(results: DataFrame, surcharge_services: DataFrame) -> DataFrame:
    """One update per (bid, service group) from product quotes; surcharge groups are left out.

    Should a group carry several quotes the largest incentive is taken, with its range. A quote
    without an incentive updates nothing.
    """
    products = results.where((F.col("mode") != catalog.SURCHARGE_MODE) & F.col("svc_group").isNotNull() & F.col("freight_incentive").isNotNull())
    kept = except_listed(products, surcharge_services, ["bid_id", "svc_group"])
    best = F.max(F.struct(F.col("freight_incentive").alias("recommended"), F.col("target_low").alias("low"), F.col("target_high").alias("high")))
    return kept.groupBy("bid_id", "svc_group").agg(best.alias("u")).select("bid_id", "svc_group", "u.*")


def surcharge_updates(results: DataFrame, surcharge_services: DataFrame) -> DataFrame:
    """One update per surcharge service group: residential or delivery-area incentive by type."""
    rows = results.where(F.col("mode") == catalog.SURCHARGE_MODE).drop("svc_group")
    joined = rows.join(surcharge_services, ["bid_id", *SURCHARGE_KEYS]).where(F.col("svc_group").isNotNull())
    kind = F.col("surcharge_type")
    value = F.when(kind == "RES", F.col("resi")).when(kind == "GDL", F.col("das"))
    best = joined.groupBy("bid_id", "svc_group").agg(F.max(value).alias("recommended"))
    return best.select("bid_id", "svc_group", "recommended", F.col("recommended").alias("low"), F.col("recommended").alias("high"))


def apply_updates(target: DataFrame, updates: DataFrame, kind: str = "P") -> DataFrame:
    """A new snapshot of the result table: rows of the key and type take the new values."""
    new = updates.select("bid_id", "svc_group", *[F.col(c).alias(f"__{c}") for c in ("recommended", "low", "high")])
    applies = F.col("result_type") == kind
    joined = target.join(new, ["bid_id", "svc_group"], "left")
    for name in ("recommended", "low", "high"):
        joined = joined.withColumn(name, F.when(applies, F.coalesce(F.col(f"__{name}"), F.col(name))).otherwise(F.col(name)))
    return joined.drop("__recommended", "__low", "__high")


def update_statements(updates: DataFrame, table: str, columns: tuple[str, str, str, str, str, str], kind: str = "P") -> DataFrame:
    """The updates as one SQL text per row, for a dry run.

    ``columns`` are the target's names for recommended, low, high, bid, service group, type.
    """
    rec, low, high, bid, group, type_ = columns
    pattern = (
        f"UPDATE {table} SET {rec} = %s, {low} = %s, {high} = %s "
        f"WHERE {bid} = '%s' AND {group} = '%s' AND {type_} = '{kind}'"
    )
    values = [F.col(c).cast("string") for c in ("recommended", "low", "high", "bid_id", "svc_group")]
    return updates.select("bid_id", "svc_group", F.format_string(pattern, *values).alias("statement"))


def scoring_status(requested: DataFrame, scored: DataFrame) -> DataFrame:
    """0 for each requested bid that has a result, 1 for the others."""
    done = scored.select("bid_id").distinct().withColumn("__done", F.lit(True))
    return requested.select("bid_id").distinct().join(done, "bid_id", "left").select(
        "bid_id", F.when(F.col("__done"), 0).otherwise(1).alias("status")
    )


def report_lines(results: DataFrame) -> DataFrame:
    """One text line per distinct product quote and per distinct surcharge."""
    surcharge = F.col("mode") == catalog.SURCHARGE_MODE

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    products = results.where(~surcharge).select("bid_id", "product", "freight_incentive", "target_low", "target_high").distinct()
    product_lines = products.select(
        "bid_id", F.format_string("%s: Inc - %s, Low - %s, High - %s", "product", text("freight_incentive"), text("target_low"), text("target_high")).alias("line")
    )
    surcharges = results.where(surcharge).select("bid_id", "description", "surcharge_type", "resi", "das").distinct()
    value = F.when(F.col("surcharge_type") == "RES", text("resi")).when(F.col("surcharge_type") == "GDL", text("das"))
    surcharge_lines = surcharges.where(value.isNotNull()).select("bid_id", F.format_string("%s: Inc - %s", "description", value).alias("line"))
    return product_lines.unionByName(surcharge_lines)


def allowed_updates(quotes: DataFrame, prior: DataFrame, ceiling_services: DataFrame, surcharge_services: DataFrame, holdout: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(updates of bids outside the hold-out, results joined to ceiling services)."""
    results = with_prior_results(quotes, prior)
    keys = ["bid_id", "svc_group"]
    in_scope = results.join(ceiling_services.select(*keys), keys) if "svc_group" in results.columns else results
    updates = product_updates(in_scope, surcharge_services).unionByName(surcharge_updates(results, surcharge_services))
    return updates_allowed(F.col("bid_id"), holdout, updates).where("update_on").drop("update_on"), in_scope


def publish(quotes: DataFrame, prior: DataFrame, ceiling_services: DataFrame, surcharge_services: DataFrame, holdout: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new snapshot of the result table, results joined to ceiling services).

    Bids in the hold-out keep their old results.
    """
    allowed, in_scope = allowed_updates(quotes, prior, ceiling_services, surcharge_services, holdout)
    return apply_updates(target, allowed), in_scope
