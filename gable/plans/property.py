"""The property-listing pipeline: stage 1, 2, 2.5, split, stage 3, runner
and export (inventory J5, J4, E14, M14, M15), composed from the generic
operators with the preset constants.

Each stage is a ``DataFrame -> DataFrame`` function, so stages 1-2.5 form
one lazy plan; only the stage-3 fit runs jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.functions import codes, text
from gable.operators import columns as C
from gable.operators import encode, joins, quality, split
from gable.operators.stage3 import Stage3, Stage3Model
from gable.plans import presets as P
from gable.session import cut_lineage
from gable.sources import files


# ---------------------------------------------------------------------------
# stage 1 (J5)
# ---------------------------------------------------------------------------

def stage1(raw: DataFrame, strict_numbers: bool = False) -> DataFrame:
    """Dedup, types, required columns, URL parts, price / VAT / numeric
    strings, yes/no, subtype + property type. With ``strict_numbers`` the
    job fails on malformed numeric text, otherwise it becomes NULL."""
    df = raw.dropDuplicates()                                            # F1
    df = C.enforce_types(df, P.CORE_DTYPES)                              # A14
    df = C.require_columns(df, P.EXPECTED_MIN_COLUMNS)                   # A13
    df = df.withColumn("price", text.to_number("price"))                 # B1
    df = C.not_null_filter(df, ["property_id", "url", "price"])          # B2
    df = encode.extract_patterns(df, "url", P.URL_PATTERNS)              # C1
    df = C.drop_null_rows(df, ["locality", "postal_code", "property_subtype"])   # B3
    df = df.withColumn("price", F.coalesce("price", F.lit(-1.0)))        # C6 (unreachable after B2)
    if "vat" in df.columns:
        df = df.withColumn("vat", text.normalize_vat("vat"))             # C6
    df = encode.clean_numeric_strings(df, P.NUMERIC_STR_COLS, strict=strict_numbers)   # C5
    df = encode.encode_yes_no(df, P.YES_NO_COLS)                         # C4
    df = df.withColumn("property_subtype", text.normalize_label("property_subtype"))   # C2
    df = df.withColumn("property_type", text.classify(                   # C3
        "property_subtype", {"House": P.HOUSE_SUBTYPES, "Apartment": P.APARTMENT_SUBTYPES}, normalize=False))
    return df


# ---------------------------------------------------------------------------
# stage 2 (J4)
# ---------------------------------------------------------------------------

def stage2_flagged(df: DataFrame) -> DataFrame:
    """Everything of stage 2 up to the ``*_unusual`` flags."""
    df = C.keep_values(df, "property_type", P.KEEP_PROPERTY_TYPES)       # B4
    df = C.drop_if_present(df, P.COLS_TO_DROP)                           # B6
    df = C.rename_if_present(df, {**P.RENAME_HOUSE, **P.RENAME_APARTMENT})   # B7
    df = encode.encode_binary_with_missing(df, P.BINARY_COLS)            # D1
    df = encode.fill_sentinel(df, P.NUMERIC_KEEP_MISSING)                # D2
    df = encode.fill_category(df, P.CATEGORICAL_KEEP_MISSING)            # D3
    df = encode.ordinal_encode(df, "state", P.STATE_GROUPED_MAPPING)     # D4
    df = encode.ordinal_encode(df, "has_equipped_kitchen", P.KITCHEN_EQUIPPED_MAPPING)   # D5
    df = encode.ordinal_encode(df, "glazing_type", P.GLAZING_MAPPING)    # D6
    df = encode.ordinal_encode(df, "heating_type", P.HEATING_MAPPING)    # D7
    df = encode.fill_sentinel(df, P.NUMERIC_KEY_FIELDS)                  # D2
    df = encode.ordinal_encode(df, "certification_electrical_installation", P.ELECTRICAL_MAPPING,
                               missing_label=None, default=-1)           # D8
    df = encode.ordinal_encode(df, "flooding_area_type", P.FLOODING_MAPPING,
                               missing_label=None, default=-1)           # D9
    df = encode.remap_values(df, "property_subtype", P.SUBTYPES_TO_DROP,
                             [P.APARTMENT_SUBTYPE_MAP, P.HOUSE_SUBTYPE_MAP])   # D10
    return quality.flag_out_of_range(df, P.PLAUSIBLE_RANGES)             # J1


def stage2(df: DataFrame, with_outliers: bool = False):
    """Clean rows (flags dropped); with ``with_outliers`` also the outliers.
    Capping (J3) is a separate operator: the source computes it and then
    discards it, so the composed stage does not apply it (Q1)."""
    clean, outliers = quality.split_outliers(stage2_flagged(df))         # J2
    return (clean, outliers) if with_outliers else clean


# ---------------------------------------------------------------------------
# stage 2.5
# ---------------------------------------------------------------------------

@dataclass
class Lookups:
    income: DataFrame     # name, median_income
    geo: DataFrame        # CD_REFNIS, TX_* names, municipality_nl_lower / fr_lower
    postal: DataFrame     # postal_code, municipality_code
    address: DataFrame    # property_id, address ...


def prepare_lookups(income: DataFrame, geo: DataFrame, postal: DataFrame, address: DataFrame) -> Lookups:
    """I1 + F2 on income (Dutch/English first, French second, file order),
    lower-cased municipality names on geo."""
    order = "__file_order" if "__file_order" in income.columns else None
    inc = joins.two_name_lookup(income, "municipality", "municipality_upper", ["median_income"], order_col=order)
    geo = geo.withColumns({"municipality_nl_lower": text.lower_strip("TX_DESCR_NL"),
                           "municipality_fr_lower": text.lower_strip("TX_DESCR_FR")})
    return Lookups(inc, geo, postal, address)


def load_lookups(spark: SparkSession, income_path: str, geo_path: str, postal_path: str, address_path: str) -> Lookups:
    return prepare_lookups(files.read_income(spark, income_path), files.read_geo(spark, geo_path),
                           files.read_postal(spark, postal_path), files.read_address(spark, address_path))


def stage25(df: DataFrame, lk: Lookups, keep_unmatched: bool = False) -> DataFrame:
    spark = df.sparkSession
    if "locality" in df.columns:
        df = df.withColumn("locality_lower", text.lower_strip("locality")).where(F.col("locality").isNotNull())
    df = df.withColumn("postal_code", text.int_key_string("postal_code"))                     # C8
    df = joins.lookup_join(df, joins.bounded(lk.postal), "postal_code")                       # E1 (fan-out)
    df = joins.lookup_join(df, joins.bounded(lk.geo), "municipality_code", "CD_REFNIS")       # E2
    names = lk.geo.select(F.col("CD_REFNIS").alias("municipality_code"), "municipality_fr_lower")
    df = joins.fallback_lookup(df, lk.income, "municipality_nl_lower", "municipality_fr_lower",
                               "municipality_code", "median_income", keep_unmatched=keep_unmatched,
                               pairs=names)                                                   # E3-E7
    df = C.rename_if_present(df, P.GEO_RENAMES)
    df = df.withColumn("province_lang", text.coalesce_blank("province_nl", "province_fr"))    # C9
    df = df.withColumn("region", codes.lookup("province_lang", P.PROVINCE_TO_REGION))         # D17
    df = joins.lookup_join(df, lk.address, "property_id")                                     # E8
    df = joins.enrich_benchmarks(df, spark, P.PRICE_TABLE_PROVINCES, P.PRICE_TABLE_REGIONS,
                                 P.PRICE_TABLE_NATIONAL)                                      # E9-E13
    return C.drop_if_present(df, P.ENRICH_DROP)                                               # B14


# ---------------------------------------------------------------------------
# runner (M14) and export
# ---------------------------------------------------------------------------

def enrich(raw: DataFrame, lk: Lookups) -> DataFrame:
    s1 = C.stamp_version(stage1(raw), "__stage1_version", P.STAGE1_VERSION)                  # A15
    s2 = C.stamp_version(stage2(s1), "__stage2_version", P.STAGE2_VERSION)
    return stage25(s2, lk)


def run_full_pipeline(raw: DataFrame, lk: Lookups, out_dir: str | None = None, preset: str = "fitter") -> dict:
    """Stages 1-2.5, split 70/15/15 by listing id, stage 3 fitted on train
    and applied to every split. With ``out_dir`` the stage outputs are
    written as Parquet (A8). The split is assigned on ``property_id``
    before the technical columns are dropped, so postal fan-out copies of
    one listing stay in one split (Q6)."""
    s1 = C.stamp_version(stage1(raw), "__stage1_version", P.STAGE1_VERSION)
    s2 = C.stamp_version(stage2(s1), "__stage2_version", P.STAGE2_VERSION)
    enriched = stage25(s2, lk)
    if out_dir:
        files.write_table(s1, f"{out_dir}/stage1")
        files.write_table(enriched, f"{out_dir}/stage2")
        enriched = files.read_table(raw.sparkSession, f"{out_dir}/stage2")
    df = split.assign_split(enriched, "property_id", P.TRAIN_VAL_TEST, seed=P.RANDOM_STATE)       # L1
    df = C.drop_if_present(df, P.TECHNICAL_COLS)                                             # B8
    df = cut_lineage(df, columnar=True)
    model = Stage3.preset(preset, materialize=False).fit(df.where(F.col("split") == "train"))
    out = model.transform(df)
    return {"stage1": s1, "stage2": enriched,
            "train": out.where(F.col("split") == "train").drop("split"),
            "val": out.where(F.col("split") == "val").drop("split"),
            "test": out.where(F.col("split") == "test").drop("split"),
            "stage3_model": model}


def export(raw: DataFrame, lk: Lookups, output_path: str, fmt: str = "parquet") -> DataFrame:
    """Stages 1-2.5 written once; returns the stage audit."""
    s1 = stage1(raw)
    s2 = stage2(s1)
    enriched = stage25(s2, lk)
    files.write_table(enriched, output_path, fmt=fmt)
    written = files.read_table(raw.sparkSession, output_path, fmt=fmt)
    return files.stage_audit({"stage1": s1, "stage2": s2, "stage2_5": written})


def score(df: DataFrame, stage3: dict[str, Stage3Model], models: dict, features: list[str]) -> DataFrame:
    """M13 on listings: House rows -> house model, everything else ->
    apartment model; stage 3 of the matching segment first; encodings
    overwrite supplied ``*_te_price`` values only where the base column
    exists (a missing base column keeps the supplied value)."""
    from gable.ml.search import score_by_segment
    house = stage3["house"].transform(df.where(F.coalesce(F.col("property_type") == "House", F.lit(False))))
    other = stage3["apartment"].transform(df.where(~F.coalesce(F.col("property_type") == "House", F.lit(False))))
    both = house.unionByName(other, allowMissingColumns=True)
    feats = C.present(both, features)
    return score_by_segment(both, models, "property_type", "House", "house", "apartment", feats,
                            keep=[c for c in ("property_id",) if c in both.columns])
