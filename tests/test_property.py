"""Property pipeline on invented fixtures: sources (A1-A5), stage 1 (J5),
stage 2 (J4), stage 2.5 (E14), runner (M14), export (M15)."""

import pytest
from pyspark.sql import functions as F

from fixtures import write_all
from gable.plans import property as prop
from gable.sources import files


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return write_all(tmp_path_factory.mktemp("fx"))


@pytest.fixture(scope="module")
def raw(spark, paths):
    return files.read_listings(spark, paths["listings"])


@pytest.fixture(scope="module")
def lookups(spark, paths):
    return prop.load_lookups(spark, paths["income"], paths["geo"], paths["postal"], paths["address"])


def by_id(df, key="property_id"):
    return {r[key]: r for r in df.collect()}


def test_income_reader_bom_and_unnamed_column(spark, paths):
    inc = files.read_income(spark, paths["income"])
    assert inc.columns[0] == "municipality_upper"          # BOM stripped
    assert "_c2" in inc.columns                            # empty header name
    assert dict(inc.dtypes)["median_income"] == "double"


def test_postal_reader_distinct_and_string_key(spark, paths):
    pc = files.read_postal(spark, paths["postal"])
    assert pc.columns == ["postal_code", "municipality_code"]
    assert pc.count() == 5


def test_stage1(raw):
    s1 = prop.stage1(raw)
    rows = by_id(s1)
    assert "P3" not in rows and "P4" not in rows           # price / postal missing
    assert s1.where(F.col("property_id") == "P1").count() == 1   # duplicate removed
    p1 = rows["P1"]
    assert (p1.leased, p1.cellar, p1.attic) == (1, 0, 1)
    assert p1.vat == "No" and p1.frontage_width == 12.0
    assert p1.property_type == "House" and p1.postal_code == "1000" and p1.locality == "brussel"
    assert rows["P2"].property_subtype == "ground floor" and rows["P2"].property_type == "Apartment"
    assert rows["P2"].frontage_width == 7.5
    assert rows["P6"].property_type == "Other"


def test_stage1_requires_columns(spark):
    df = spark.createDataFrame([("a",)], "url string")
    with pytest.raises(ValueError, match="Missing expected raw columns"):
        prop.stage1(df)


def test_stage2(raw):
    clean, outliers = prop.stage2(prop.stage1(raw), with_outliers=True)
    rows = by_id(clean)
    assert set(rows) == {"P1", "P2", "P8", "P9", "P11", "P13"}
    assert set(by_id(outliers)) == {"P7", "P10"}
    assert not [c for c in clean.columns if c.endswith("_unusual")]
    p1, p2 = rows["P1"], rows["P2"]
    assert p1.has_garage == -1 and p1.is_furnished == 1 and p1.has_garden == -1
    assert (p1.state, p1.has_equipped_kitchen, p1.glazing_type, p1.heating_type) == (4, 3, 1, 3)
    assert p1.certification_electrical_installation == 1 and p1.flooding_area_type == 1
    assert p2.state is None                                # unmapped label stays NULL (Q4)
    assert p2.heating_type == -1 and p2.glazing_type == -1 and p2.has_equipped_kitchen == -1
    assert p2.certification_electrical_installation == -1 and p2.flooding_area_type == -1
    assert p2.property_subtype == "apartment"              # ground floor remapped
    assert rows["P9"].area == -1.0                         # missing -> -1, exempt from range
    assert "vat" not in clean.columns and "p_score" not in clean.columns
    assert "attic_house" in clean.columns and "has_garage" in clean.columns


def test_stage25(raw, lookups):
    out = prop.stage25(prop.stage2(prop.stage1(raw)), lookups)
    rows = out.collect()
    ids = sorted(r.property_id for r in rows)
    assert ids == ["P1", "P13", "P13", "P2", "P2", "P8", "P9"]     # P11 unmatched; fan-outs
    r = {(x.property_id, x.municipality_nl, x.address): x for x in rows}
    p1 = r[("P1", "Brussel", "Rue 1")]
    assert p1.median_income == 30.5                        # French-name fallback
    assert p1.region == "Brussels" and p1.province is None # empty Dutch province -> French -> region
    assert p1.national_benchmark_m2 == 2076.0 and p1.province_benchmark_m2 is None
    assert p1.region_benchmark_m2 == 3308.0                # house column for a House
    p2 = [x for x in rows if x.property_id == "P2"]
    assert {x.address for x in p2} == {"Rue 2", "Rue 2 bis"} and {x.median_income for x in p2} == {28.1}
    assert p2[0].region_benchmark_m2 == 3423.0             # apartment column
    p8 = [x for x in rows if x.property_id == "P8"][0]
    assert p8.median_income == 25.0 and p8.region == "Flanders" and p8.province == "Provincie Antwerpen"
    assert p8.province_benchmark_m2 == 2419.0 and p8.postal_code == "2000"
    p13 = {x.municipality_nl: x.median_income for x in rows if x.property_id == "P13"}
    assert p13 == {"Waver": 33.0, "Eigenbrakel": 35.0}
    for dropped in ("locality_lower", "municipality_code", "CD_REFNIS", "name", "province_lang"):
        assert dropped not in out.columns


def test_run_full_pipeline_and_export(spark, raw, lookups, tmp_path):
    res = prop.run_full_pipeline(raw, lookups, out_dir=str(tmp_path / "stages"))
    parts = [res[k] for k in ("train", "val", "test")]
    assert sum(p.count() for p in parts) == 7
    train = res["train"]
    for c in ("property_id", "url", "address", "__stage1_version"):
        assert c not in train.columns
    assert "area_missing" in train.columns and "locality_te_price" in train.columns
    all_rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # fitter preset imputes medians; the target encodings never stay NULL
    assert all_rows.where(F.col("postal_code_te_price").isNull()).count() == 0
    audit = prop.export(raw, lookups, str(tmp_path / "export"))
    got = {r.stage: r.n_rows for r in audit.collect()}
    assert got == {"stage1": 10, "stage2": 6, "stage2_5": 7}


def test_segment_scoring_on_listings(spark, raw, lookups):
    from gable.ml.features import assemble, select_feature_columns
    from gable.ml.models import make_regressor
    from gable.operators.stage3 import Stage3
    enriched = prop.enrich(raw, lookups).drop("__stage1_version", "__stage2_version").checkpoint()
    spec = Stage3.preset("training")
    s3, regs, feats = {}, {}, None
    for name, cond in (("house", F.col("property_type") == "House"), ("apartment", F.col("property_type") != "House")):
        part = enriched.where(cond)
        s3[name] = spec.fit(part)
        frame, f = select_feature_columns(s3[name].transform(part), "price", "training")
        feats = sorted(set(f) & set(feats or f))
        regs[name] = frame
    for name in regs:
        m = assemble(regs[name].na.fill(0.0), feats, "price").df
        regs[name] = make_regressor("xgb", {"maxIter": 2, "maxDepth": 2}).fit(m)
    # a new listing that supplies its own locality encoding but has no locality column
    new = enriched.drop("locality").withColumn("locality_te_price", F.lit(123.0))
    scored = prop.score(new.na.fill(0.0, subset=[c for c in feats if c in new.columns]), s3, regs, feats)
    got = {(r.property_id, r.model) for r in scored.collect()}
    assert {m for _, m in got} == {"house", "apartment"}
    assert {pid for pid, m in got if m == "house"} == {"P1", "P8"}


def test_familiar_entry_points(spark, paths, lookups):
    from gable import api
    s1 = api.load_and_clean_stage1(spark, paths["listings"])
    s25 = api.stage25_geo_enrichment(api.stage2_pipeline(s1), lookups).checkpoint()
    assert s25.count() == 7
    fitted = api.fit_stage3(s25)
    out = api.transform_stage3(s25, fitted)
    m = api.prepare_X_y(out.na.fill(0.0), "training")
    assert "area_log" not in m.features and "postal_code_te_price" in m.features
    assert m.df.count() == 7
    one = api.stage3_pipeline(s25)
    assert "postal_price_mean" in one.columns


def test_export_as_csv(spark, raw, lookups, tmp_path):
    audit = prop.export(raw, lookups, str(tmp_path / "export_csv"), fmt="csv")
    assert {r.stage: r.n_rows for r in audit.collect()}["stage2_5"] == 7
    back = spark.read.option("header", True).csv(str(tmp_path / "export_csv"))
    assert back.count() == 7 and "median_income" in back.columns
