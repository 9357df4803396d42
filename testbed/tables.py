"""Bind the driver's star schema to the canonical source tables.

A bid is three neighbouring orders, a service group one of twenty part classes. Prices are
held to 1/1024 of a unit, so that sums of price x quantity are exact in any order.

Lines and orders are placed by bid where they are read: every later grouping and join of lines is
keyed by the bid and more, so it finds its rows in place and shuffles nothing again.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenderline import catalog
from tenderline.catalog import values_frame
from tenderline.session import SESSION_DEFAULTS

PRODUCT_ORDER = list(catalog.PRODUCT_MODES)
#: Columns of a line that volumes, target prices and surcharges read.
SHARED_LINE = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_discount"]


def cents(value: Column) -> Column:
    """Hold a price to 1/1024 (rounded down)."""
    return F.floor(value * 1024.0) / F.lit(1024.0)


def name_shared_folder(spark: SparkSession) -> None:
    """On a local master without ``spark.checkpoint.dir``, name a folder of this machine for intermediate tables."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="testbed-"))


def join_where_placed(spark: SparkSession) -> None:
    """Join rows that are placed by bid where they are, as ``build_session`` does, in a session made elsewhere."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(key, SESSION_DEFAULTS[key])


class Tables:
    """The source tables at one data folder; every attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        name_shared_folder(spark)
        join_where_placed(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    # --- lines -------------------------------------------------------------------
    def _placed(self) -> DataFrame:
        number = F.expr("l_orderkey div 3")
        return self.raw("lineitem").withColumn("bid_id", F.concat(F.lit("B"), number.cast("string")))

    def _line(self) -> DataFrame:
        """Lines for readers that share one shuffle.

        A line travels as one struct, so that the columns a reader leaves out stay in it: the
        shuffles of all readers are equal, and Spark makes one of them and reads it again.
        """
        line = F.struct(*SHARED_LINE).alias("line")
        placed = self._placed().select("bid_id", line).repartition("bid_id")
        return self._with_prices(placed.select("bid_id", F.inline(F.array("line"))))

    def _with_prices(self, placed: DataFrame) -> DataFrame:
        c = F.col
        return placed.select(
            "*", F.expr("l_orderkey div 3").alias("bid_number"),
            F.expr("CAST(l_partkey % 20 AS INT)").alias("svc_group"),
            cents(c("l_extendedprice") / F.lit(100.0)).alias("line_rev"),
            cents(c("l_extendedprice") / c("l_quantity") / F.lit(100.0)).alias("price_pp"),
        )

    @property
    def service_groups(self) -> DataFrame:
        c = F.col
        # no other source reads these columns, nor rows without a bid: a shuffle of their own is the smaller
        sums = self._with_prices(self._placed().repartition("bid_id")).groupBy("bid_id", "svc_group").agg(
            F.sum("l_quantity").alias("volume"),
            F.sum("line_rev").alias("rev"),
            F.min("l_tax").alias("tax"), F.min("l_discount").alias("discount"),
            F.min("l_suppkey").alias("supplier"), F.min("l_linenumber").alias("first_line"), F.min("l_partkey").alias("part"),
            F.sum(F.when(c("l_returnflag") == "R", c("l_quantity")).otherwise(0.0)).alias("prior_volume"),
        )
        priced = (
            sums.withColumn("list_pp", cents(c("rev") / c("volume")))
            .withColumn("freight_pp", cents(c("list_pp") * (1.0 - c("tax"))))
            .withColumn("last_digit", c("svc_group") % 10)
        )
        supplier = c("supplier") % 4
        return priced.select(
            "bid_id", "svc_group",
            F.when(c("last_digit") == 8, "I").when(c("last_digit") == 9, "E").otherwise("N").alias("direction"),
            F.concat(F.lit("S"), c("last_digit").cast("string")).alias("svc_type"),
            F.when(c("svc_group") >= 10, "F1").otherwise("F0").alias("feature"),
            F.lit("PKG").alias("package_type"),
            (c("part") % 50 + 1).cast("double").alias("density"),
            F.when(supplier == 0, 15).when(supplier == 1, 60).otherwise(c("supplier") % 7 + 40).cast("int").alias("competitor_code"),
            "volume", "prior_volume", "list_pp", "freight_pp",
            cents(c("list_pp") * (0.4 + (c("supplier") % 20) / F.lit(100.0))).alias("marg_cost_pp"),
            cents(c("list_pp") * 0.9).alias("full_cost_pp"),
            F.when(c("first_line") % 3 == 0, 0.0).otherwise(cents(c("freight_pp") * (1.0 - c("discount")))).alias("comp_keyed_pp"),
        )

    @property
    def shipper_volumes(self) -> DataFrame:
        c = F.col
        bid_id = F.concat(F.lit("B"), F.expr("o_orderkey div 3").cast("string")).alias("bid_id")
        orders = self.raw("orders").select(bid_id, c("o_orderkey").alias("l_orderkey"), "o_custkey").repartition("bid_id")
        had_prior = c("l_returnflag") != "N"
        return self._line().join(orders, ["bid_id", "l_orderkey"]).select(
            "bid_id", "svc_group",
            F.concat(F.lit("A"), F.lpad(c("o_custkey").cast("string"), 9, "0")).alias("account"),
            c("l_linenumber").alias("tier"), c("l_quantity").alias("qty"), "price_pp",
            F.when(had_prior, cents(c("price_pp") * 0.9) * 13.0).otherwise(0.0).alias("prior_gross_pp"),
            F.when(had_prior, cents(c("price_pp") * 0.9 * (1.0 - 3.0 * c("l_discount"))) * 13.0).otherwise(0.0).alias("prior_net_pp"),
        )

    @property
    def target_prices(self) -> DataFrame:
        c = F.col
        return self._line().select(
            "bid_id", "svc_group", (c("l_linenumber") % 3).cast("double").alias("factor"),
            cents(c("price_pp") * 0.9).alias("comp_est_pp"), cents(c("price_pp") * 0.7).alias("target_pp"),
            cents(c("price_pp") * 0.65).alias("target_low_pp"), cents(c("price_pp") * 0.72).alias("target_high_pp"),
        )

    @property
    def raw_zone_weights(self) -> DataFrame:
        c = F.col
        digit = c("l_suppkey") % 10
        zone = (
            F.when(c("l_linenumber") == 7, "ALL").when(c("l_suppkey") % 97 == 0, "44")
            .when(digit < 7, (digit + 2).cast("string")).otherwise((digit + 39).cast("string"))
        )
        return self._with_prices(self._placed().repartition("bid_id")).select(
            "bid_id", "svc_group", zone.alias("zone"),
            F.when(c("l_linenumber") == 1, "OZ").otherwise("LB").alias("unit"),
            ((c("l_quantity") - 1.0) * 2.5).alias("category_weight"),
            (c("l_partkey") % 9 + 1).cast("double").alias("package_volume"),
        )

    @property
    def ceiling_services(self) -> DataFrame:
        return self._line().where(F.col("svc_group") % 4 != 3).select("bid_id", "svc_group").distinct()

    @property
    def prior_results(self) -> DataFrame:
        groups = self._line().groupBy("bid_id", "svc_group").agg(F.min("l_linenumber").alias("line"))
        kinds = F.explode(F.array(F.lit("P"), F.lit("T")))
        base = F.col("line") / F.lit(16.0)
        return groups.select(
            "bid_id", "svc_group", kinds.alias("result_type"),
            base.alias("recommended"), (base - 0.0625).alias("low"), (base + 0.0625).alias("high"),
        )

    @property
    def surcharge_services(self) -> DataFrame:
        line = self._line().where(F.col("svc_group") == 17).select("bid_id", "bid_number", "svc_group").distinct()
        return line.select(
            "bid_id", "svc_group", F.lit("N").alias("direction"), F.lit("F1").alias("feature"), F.lit("S7").alias("svc_type"),
            F.when(F.col("bid_number") % 2 == 0, "RES").otherwise("GDL").alias("surcharge_type"),
            F.lit("PKG").alias("package_type"), F.lit("A").alias("acquisition"),
        )

    # --- bids and shippers ---------------------------------------------------------
    @property
    def bids(self) -> DataFrame:
        c = F.col
        grouped = self.raw("orders").groupBy(F.expr("o_orderkey div 3").alias("n")).agg(
            F.min("o_orderstatus").alias("s"), F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
        )
        status = F.when(c("n") % 7 == 0, "C").when(c("n") % 11 == 0, "$").when(c("s") == "F", "A").when(c("s") == "O", "R").otherwise("P")
        return grouped.select(
            F.concat(F.lit("B"), c("n").cast("string")).alias("bid_id"),
            (c("n") % 6).cast("string").alias("category_code"), status.alias("status"), c("last").alias("status_date"),
            F.when(c("n") % 13 != 0, F.date_add(c("last"), -(c("n") % 120).cast("int"))).alias("proposed_date"),
            c("first").alias("init_date"), (c("n") % 4).cast("int").alias("reason_code"),
        )

    @property
    def shippers(self) -> DataFrame:
        c = F.col
        nation = F.broadcast(self.raw("nation")).select(c("n_nationkey").alias("c_nationkey"), "n_regionkey")
        pairs = self.raw("orders").select(F.expr("o_orderkey div 3").alias("n"), c("o_custkey").alias("c_custkey")).distinct()
        return pairs.join(self.raw("customer"), "c_custkey").join(nation, "c_nationkey").select(
            F.concat(F.lit("B"), c("n").cast("string")).alias("bid_id"),
            F.concat(F.lit("A"), F.lpad(c("c_custkey").cast("string"), 9, "0")).alias("account"),
            F.concat(F.lit("1"), F.lpad((c("c_custkey") % 11).cast("string"), 2, "0")).alias("industry_code"),
            F.lpad(c("c_nationkey").cast("string"), 2, "0").alias("district"),
            F.lpad(c("n_regionkey").cast("string"), 2, "0").alias("region"),
        ).repartition("bid_id")

    # --- lookups, generated from rules ------------------------------------------------
    @property
    def service_products(self) -> DataFrame:
        rows = []
        for group in range(20):
            digit = group % 10
            if group == 18:
                continue  # a service without a product
            product = "Unknown" if group == 19 else PRODUCT_ORDER[digit]
            direction = {8: "I", 9: "E"}.get(digit, "N")
            rows.append((direction, f"S{digit}", f"F{group // 10}", product))
        return values_frame(self.spark, "direction string, svc_type string, feature string, product string", rows)

    @property
    def bands(self) -> DataFrame:
        return values_frame(self.spark, "product string, min_rev double, max_rev double, ceiling double", band_rows())

    @property
    def surcharge_breaks(self) -> DataFrame:
        return values_frame(self.spark, "surcharge_type string, break double, incentive double", SURCHARGE_BREAKS)

    @property
    def surcharge_map(self) -> DataFrame:
        return values_frame(
            self.spark,
            "product string, direction string, feature string, svc_type string, surcharge_type string, package_type string, acquisition string, description string",
            surcharge_map_rows(),
        )

    @property
    def industry_map(self) -> DataFrame:
        return values_frame(self.spark, "industry_code string, segment string", industry_rows())

    @property
    def overlay(self) -> DataFrame:
        return values_frame(self.spark, "district int, industry string, product string, increment double", overlay_rows())

    @property
    def holdout(self) -> DataFrame:
        return values_frame(self.spark, "digit int, is_on boolean", [(d, d != 3) for d in range(10) if d != 8])

    @property
    def segments(self):
        from tenderline.plans.segments import SegmentTables

        frame = lambda schema, rows: values_frame(self.spark, schema, rows)
        return SegmentTables(
            frame("mode string, tier int, tier_segment string", segment_tiers()),
            frame("mode string, min_value double, max_value double, density_segment string", segment_densities()),
            frame("mode string, min_value double, max_value double, size_segment string", segment_sizes()),
            frame("mode string, tier_segment string, density_segment string, size_segment string, cohort string", segment_cohorts()),
            frame("mode string, cohort string, incentive double", segment_incentives()),
        )


# --- rows of the lookups (used for Spark and, as VALUES, for the check SQL) -------------
def band_rows() -> list[tuple]:
    edges = [0.0, 500.0, 1000.0, 2000.0, 4000.0, 6000.0, 9000.0, 14000.0, 9999999.0]
    return [
        (product, edges[i], edges[i + 1], round(0.30 + 0.05 * i + 0.01 * (n % 3), 2))
        for n, product in enumerate(PRODUCT_ORDER)
        for i in range(len(edges) - 1)
    ]


# Surcharge breaks
SURCHARGE_BREAKS = [
    ("RES", 0.1, 0.0), ("RES", 0.15, 0.0), ("RES", 0.2, 0.0), ("RES", 0.27, 0.25), ("RES", 0.35, 0.25),
    ("GDL", 2000.0, 0.0), ("GDL", 5000.0, 0.0), ("GDL", 7000.0, 0.25), ("GDL", 10000.0, 0.25),
]


def surcharge_map_rows() -> list[tuple]:
    return [
        (product, "N", "F1", "S7", kind, "PKG", "A", f"{kind} {product}")
        for product in catalog.GROUND_FAMILY + catalog.AIR_FAMILY
        for kind in ("RES", "GDL")
    ]


def industry_rows() -> list[tuple]:
    return [(f"1{i:02d}", name) for i, name in enumerate(catalog.INDUSTRIES)] + [("109", "Not a known segment")]


def overlay_rows() -> list[tuple]:
    names = list(catalog.INDUSTRIES)
    return [(d, names[d % 9], p, 0.0625 * (1 + d % 3)) for d in range(25) for p in PRODUCT_ORDER if (d + len(p)) % 2 == 0]


def segment_tiers() -> list[tuple]:
    return [(m, t, f"T{(t + 1) // 3}") for m in catalog.HEAVY_MODES for t in range(0, 7)]


def segment_densities() -> list[tuple]:
    return [(m, lo, hi, f"D{i}") for m in catalog.HEAVY_MODES for i, (lo, hi) in enumerate([(0.0, 10.0), (10.0, 25.0), (25.0, 1e9)])]


def segment_sizes() -> list[tuple]:
    return [(m, lo, hi, f"S{i}") for m in catalog.HEAVY_MODES for i, (lo, hi) in enumerate([(0.0, 2000.0), (2000.0, 8000.0), (8000.0, 1e9)])]


def segment_cohorts() -> list[tuple]:
    return [
        (m, f"T{t}", f"D{d}", f"S{s}", f"C{(t + d + s) % 5}")
        for m in catalog.HEAVY_MODES for t in range(3) for d in range(3) for s in range(3)
    ]


def segment_incentives() -> list[tuple]:
    return [(m, f"C{k}", round(0.04 * (k + 1) + 0.01 * i, 2)) for i, m in enumerate(catalog.HEAVY_MODES) for k in range(5)]
