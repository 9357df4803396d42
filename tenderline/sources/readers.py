"""Readers of source tables, lookups, typed files and variable lists."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tenderline.operators.aggregates import stacked
from tenderline.operators.joins import only_listed
from tenderline.plans.segments import SegmentTables

# Types named by a (feature, type) dictionary
DICTIONARY_TYPES = {"str": T.StringType(), "float64": T.DoubleType(), "int64": T.LongType(), "int32": T.IntegerType()}
NULL_MARKERS = ("", "NA", "NULL")

# Source column codes and the canonical name of each; * stands for any carrier prefix
SOURCE_COLUMNS = {
    "bids": {
        "NVP_BID_NR": "bid_id", "NVP_BID_CGY_TYP_CD": "category_code", "NVP_BID_STS_CD": "status", "BID_STS_EFF_DT": "status_date",
        "NVP_BID_INI_DT": "init_date", "NVP_BID_PRP_DT": "proposed_date", "NVP_BID_RQT_RSN_CD": "reason_code",
    },
    "shippers": {"NVP_BID_NR": "bid_id", "SHR_AC_NR": "account", "SIC_CD": "industry_code", "DIS_NR": "district", "REG_NR": "region"},
    "service_groups": {
        "NVP_BID_NR": "bid_id", "SVC_GRP_NR": "svc_group", "MVM_DRC_CD": "direction", "SVC_TYP_CD": "svc_type",
        "PKG_CHA_TYP_CD": "package_type", "SVC_FEA_TYP_CD": "feature", "CALC_CUBE_PACKAGE_DENSITY": "density",
        "CPE_CRR_NR": "competitor_code", "BID_*_PJT_WVL_QY": "volume", "BID_CUS_PRR_WVL_QY": "prior_volume",
        "NVP_BID_FRT_GRR_A": "list_pp", "*_PRJ_GRS_RPP_A": "freight_pp", "BID_MRG_CPP_A": "marg_cost_pp",
        "BID_FA_CPP_A": "full_cost_pp", "CPE_SVC_RPP_A": "comp_keyed_pp",
    },
    "shipper_volumes": {
        "NVP_BID_NR": "bid_id", "SVC_GRP_NR": "svc_group", "SHR_AC_NR": "account", "RA_TRI_NR": "tier", "SHR_PJT_WVL_QY": "qty",
        "SHR_PJT_GRS_RPP_A": "price_pp", "SHR_PRR_GRS_RVN_A": "prior_gross_pp", "SHR_PRR_NET_RVN_A": "prior_net_pp",
    },
    "target_prices": {
        "NVP_BID_NR": "bid_id", "SVC_GRP_NR": "svc_group", "TRG_PSE_FCR_NR": "factor", "CPE_ETM_RPP_A": "comp_est_pp",
        "SVC_GRP_TRG_PSE_A": "target_pp", "SVC_TRG_LOW_RNG_A": "target_low_pp", "SVC_TRG_HI_RNG_A": "target_high_pp",
    },
    "zone_weights": {
        "NVP_BID_NR": "bid_id", "SVC_GRP_NR": "svc_group", "DEL_ZN_NR": "zone", "WGT_MS_UNT_TYP_CD": "unit",
        "WGT_CGY_WGY_QY": "category_weight", "ADJ_PKG_VOL_QY": "package_volume",
    },
    "ceiling_services": {"NVP_BID_NR": "bid_id", "SVC_GRP_NR": "svc_group"},
    "prior_results": {
        "NVP_BID_NR": "bid_id", "SVC_GRP_NR": "svc_group", "NCV_DTR_DAT_TYP_CD": "result_type",
        "RCM_NCV_QY": "recommended", "NCV_MIN_QY": "low", "NCV_MAX_QY": "high",
    },
    "surcharge_services": {
        "NVP_BID_NR": "bid_id", "SVC_GRP_NR": "svc_group", "MVM_DRC_CD": "direction", "SVC_FEA_TYP_CD": "feature",
        "SVM_TYP_CD": "svc_type", "ASY_SVC_TYP_CD": "surcharge_type", "PKG_CHA_TYP_CD": "package_type", "PKG_ACQ_MTH_TYP_CD": "acquisition",
    },
    "service_products": {"Product": "product", "SVM_TYP_CD": "svc_type", "MVM_DRC_CD": "direction", "SVC_FEA_TYP_CD": "feature"},
    "bands": {"Product": "product", "Min_List_Rev_Wkly": "min_rev", "Max_List_Rev_Wkly": "max_rev", "Off_Inc_Cap": "ceiling"},
    "surcharge_breaks": {"Type": "surcharge_type", "Breaks": "break", "Incentive": "incentive"},
    "holdout": {"Digit": "digit", "On": "is_on"},
    "industry_map": {"Business Defined SIC Industry 4 Cd": "industry_code", "Business Defined SIC Industry Segment Descr": "segment"},
    "overlay": {"Bid_District": "district", "DominantIndustry": "industry", "Product": "product", "VolIncrement": "increment"},
}
DOUBLE_COLUMNS = {
    "density", "volume", "prior_volume", "list_pp", "freight_pp", "marg_cost_pp", "full_cost_pp", "comp_keyed_pp", "qty", "price_pp",
    "prior_gross_pp", "prior_net_pp", "factor", "comp_est_pp", "target_pp", "target_low_pp", "target_high_pp", "category_weight",
    "package_volume", "recommended", "low", "high", "min_rev", "max_rev", "ceiling", "break", "incentive", "increment",
}
INTEGER_COLUMNS = {"competitor_code", "reason_code", "tier", "digit", "district_number"}
DATE_COLUMNS = {"status_date", "init_date", "proposed_date"}


def projected(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the named columns; the projection reaches the scan."""
    return df.select(*columns)


def canonical(raw: DataFrame, table: str, fillers: tuple[str, ...] = ()) -> DataFrame:
    """Rename a source table's columns to canonical names and give them their types.

    Text is expected for typed columns read from all-text files; what does not parse is NULL.
    """
    from tenderline.functions.scalars import source_date

    kinds = {f.name: f.dataType for f in raw.schema.fields}

    def typed(code: str, name: str) -> Column:
        value, is_text = F.col(f"`{code}`"), isinstance(kinds[code], T.StringType)
        if name in DOUBLE_COLUMNS:
            value = F.trim(value).try_cast("double") if is_text else value.cast("double")
        elif name in INTEGER_COLUMNS:
            value = F.trim(value).try_cast("int") if is_text else value.cast("int")
        elif name in DATE_COLUMNS and is_text:
            value = source_date(value, fillers=fillers)
        elif name == "is_on" and is_text:
            value = value.try_cast("boolean")
        return value.alias(name)

    found = []
    for code, name in SOURCE_COLUMNS[table].items():
        hits = [c for c in raw.columns if fnmatch(c, code)]
        if len(hits) > 1:
            raise ValueError(f"{table}: {name} could be any of {', '.join(hits)}")
        found += [(c, name) for c in hits]
    return raw.select(*[typed(code, name) for code, name in found])


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text, so that leading zeros survive."""
    return spark.read.csv(path, header=True, inferSchema=False)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a declared schema, matched to the header."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types; costs a pass over the file, so for small lookups only."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_marked_csv(spark: SparkSession, path: str, markers: tuple[str, ...] = NULL_MARKERS) -> DataFrame:
    """Text CSV without leading blanks in which the markers stand for a missing value."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*markers), F.col(f"`{c}`")).alias(c) for c in raw.columns])


def dictionary_types(dictionary: DataFrame) -> dict[str, T.DataType]:
    """(feature, type) rows as a mapping. The dictionary has a row per column of one table."""
    return {row["feature"]: DICTIONARY_TYPES[row["type"]] for row in dictionary.select("feature", "type").toLocalIterator()}


def schema_from_dictionary(dictionary: DataFrame, columns: list[str]) -> T.StructType:
    """Schema of a file's columns, text where the dictionary does not know a column."""
    kinds = dictionary_types(dictionary)
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns])


def read_by_dictionary(spark: SparkSession, path: str, dictionary: DataFrame) -> DataFrame:
    """CSV typed by a dictionary; only the header is read to learn the column order."""
    header = spark.read.csv(path, header=True, inferSchema=False).columns
    return read_typed_csv(spark, path, schema_from_dictionary(dictionary, header))


def recast(df: DataFrame, kinds: dict[str, T.DataType | str]) -> DataFrame:
    """Cast the columns a dictionary knows; values that do not fit become NULL."""
    return df.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def read_bids(tables: dict[str, DataFrame], wanted: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every source table, cut down to the wanted bids by a semi join."""
    return tables if wanted is None else {name: only_listed(df, wanted, ["bid_id"]) for name, df in tables.items()}


def read_source(spark: SparkSession, location: dict[str, str] | str, table: str, kind: str = "parquet", fillers: tuple[str, ...] = ()) -> DataFrame:
    """One source table from parquet, CSV or JDBC, with canonical columns.

    For JDBC ``location`` holds the connection options; give numPartitions with a partition
    column there, so that the table is read by many tasks.
    """
    if kind == "jdbc":
        raw = spark.read.format("jdbc").options(**location).load()
    elif kind == "csv":
        raw = read_text_csv(spark, location)
    else:
        raw = spark.read.parquet(location)
    return canonical(raw, table, fillers)


def read_segment_bundle(spark: SparkSession, paths: dict[tuple[str, str], str]) -> SegmentTables:
    """The bundle from one CSV per (mode, table); modes become a column of each table."""
    # Column names of the segment files
    names = {
        "tiers": {"COMMODITY TIER": ("tier", "int"), "SEGMENT": ("tier_segment", "string")},
        "densities": {"MIN VALUE": ("min_value", "double"), "MAX VALUE": ("max_value", "double"), "SEGMENT": ("density_segment", "string")},
        "sizes": {"MIN VALUE": ("min_value", "double"), "MAX VALUE": ("max_value", "double"), "SEGMENT": ("size_segment", "string")},
        "cohorts": {
            "COMM TIER SEGMENT": ("tier_segment", "string"), "DENSITY SEGMENT": ("density_segment", "string"),
            "BID LIST REV WEEKLY SEGMENT": ("size_segment", "string"), "COHORT": ("cohort", "string"),
        },
        "incentives": {"COHORT": ("cohort", "string"), "INCENTIVE": ("incentive", "double")},
    }
    built = {}
    for table, columns in names.items():
        parts = []
        for (mode, which), path in paths.items():
            if which == table:
                raw = read_marked_csv(spark, path)
                parts.append(raw.select(F.lit(mode).alias("mode"), *[F.col(f"`{c}`").try_cast(k).alias(n) for c, (n, k) in columns.items()]))
        built[table] = stacked(parts)
    return SegmentTables(**built)


def read_variable_lists(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(list, feature, type) rows of the named CSV files of a folder."""
    rows = spark.read.csv(f"{folder}/*.csv", header=True, schema="Feature string, Type string")
    file = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)
    return rows.select(file.alias("list"), F.col("Feature").alias("feature"), F.col("Type").alias("type")).where(F.col("list").isin(names))
