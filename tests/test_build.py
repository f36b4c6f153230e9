"""Batch build: models written in order, checks gate publication."""

import os

import pytest
from pyspark.sql import functions as F

from cohortlens.plans import quality
from cohortlens.plans.build import MODEL_ORDER, Models, build_all
from cohortlens.sources import fixtures
from cohortlens.sources.readers import load, read_csv_by_name, read_raw_sources
from cohortlens.sources.schemas import RAW_COLUMNS
from cohortlens.sources.tables import Store

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_build_all_writes_tables_and_reads_back(spark, scratch):
    raw = fixtures.raw_sources(spark, SF)
    built = build_all(raw, base=os.path.join(scratch, "tables"))
    for name in MODEL_ORDER:
        assert os.path.isdir(os.path.join(scratch, "tables", name))
    assert built.fct_user_journey.count() == 200
    # downstream models read the written tables, not the raw plan
    plan = built.mart_campaign_performance._jdf.queryExecution().analyzed().toString()
    assert "fct_user_journey" in plan or "parquet" in plan.lower()
    report = quality.check_report(built)
    rows = {(r.model, r.test, r.column_name): r.violations for r in report.collect()}
    assert rows[("fct_user_journey", "unique", "user_id")] == 0
    assert rows[("stg_dim_user", "accepted_values", "country")] == 0


def test_gate_stops_on_violation(spark):
    mart = spark.createDataFrame(
        [("C1", 1, 2, 0, 0, 10.0, 0.0, 0.0, 2.0, 0.0, None, None, 0.0, 0.0)],
        "campaign_id string, attributed_users long, trial_users long, sale_users long, "
        "sale_without_trial_users long, total_spend double, initial_sale_revenue double, "
        "total_sale_revenue double, trial_rate double, sale_rate double, cost_per_trial double, "
        "cost_per_sale double, initial_revenue_roas double, total_revenue_roas double",
    )
    v = quality.campaign_rule_violations(mart)
    assert v.count() == 1  # more trials than users, rate > 1, cost null with trials
    with pytest.raises(quality.CheckFailed):
        quality.gate(quality.violation_count(v, "mart_campaign_performance", "campaign_rules"))


def test_a_broken_journey_stops_what_depends_on_it(spark, scratch, monkeypatch):
    """A journey that breaks its rules is not followed by mart or features."""
    from cohortlens.plans import build as build_module

    whole = build_module.journey.fct_user_journey

    def broken(*args, **kw):
        return whole(*args, **kw).withColumn("made_sale", F.lit(7))

    monkeypatch.setattr(build_module.journey, "fct_user_journey", broken)
    base = os.path.join(scratch, "tables")
    with pytest.raises(quality.CheckFailed):
        build_all(fixtures.raw_sources(spark, SF), base=base, checks=quality.gate_model)
    left = set(os.listdir(base))
    assert "fct_user_journey" in left and not left & {"mart_campaign_performance", "user_features"}
    assert Store(spark, base).published() == {}


def test_a_failed_build_leaves_the_former_tables(spark, scratch, monkeypatch):
    """A build that breaks a rule, and one that dies while it writes, leave
    every model of the build before readable and unchanged."""
    from cohortlens.plans import build as build_module

    base, raw = os.path.join(scratch, "tables"), fixtures.raw_sources(spark, SF)
    build_all(raw, base=base, checks=quality.gate_model)
    before = Store(spark, base).published()
    whole = build_module.journey.fct_user_journey

    def broken(*args, **kw):
        return whole(*args, **kw).withColumn("made_sale", F.lit(7))

    def dying(*args, **kw):  # half of the rows are written when the job fails
        rows = whole(*args, **kw)
        return rows.withColumn("gender", F.when(F.crc32("user_id") % 2 == 0, F.col("gender")).otherwise(F.raise_error(F.lit("lost")).cast("string")))

    for bad, error in ((broken, quality.CheckFailed), (dying, Exception)):
        monkeypatch.setattr(build_module.journey, "fct_user_journey", bad)
        with pytest.raises(error):
            build_all(raw, base=base, checks=quality.gate_model)
        assert Store(spark, base).published() == before
        assert load(spark, "fct_user_journey", base).agg(F.max("made_sale")).first()[0] == 1
        assert load(spark, "user_features", base).count() == 200
    monkeypatch.setattr(build_module.journey, "fct_user_journey", whole)
    build_all(raw, base=base, checks=quality.gate_model)
    after = Store(spark, base).published()
    assert set(after) == set(MODEL_ORDER) and all(after[n] != before[n] for n in MODEL_ORDER)


def test_csv_sources_round_trip(spark, scratch):
    """Raw CSV read with a declared all-string schema, then the same models."""
    raw = fixtures.raw_sources(spark, SF)
    base = os.path.join(scratch, "raw")
    for name, df in raw.items():
        df.coalesce(1).write.option("header", True).csv(os.path.join(base, f"{name}.csv"))
    from_csv = read_raw_sources(spark, base, "csv")
    for name, cols in RAW_COLUMNS.items():
        assert tuple(from_csv[name].columns) == cols
    a = Models(from_csv).mart_campaign_performance.select("campaign_id", "attributed_users", "sale_users")
    b = Models(raw).mart_campaign_performance.select("campaign_id", "attributed_users", "sale_users")
    assert sorted(a.collect()) == sorted(b.collect())
    assert Models(from_csv).fct_user_journey.where(F.col("onboarding_at").isNull()).count() == 0


def write_file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_csv_columns_go_by_name(spark, scratch):
    """Files of one folder with the columns in another order, with other
    columns beside them, untidy names, and without rows."""
    folder = os.path.join(scratch, "raw of may", "marketing_campaigns.csv")
    write_file(folder, "a.csv", "campaign_id,campaign_name,campaign_type\nC001,Spring,Social\n")
    write_file(folder, "b.csv", 'note,Campaign_Type,campaign_id, campaign_name\n"x, y",Video,C002,"Late, long"\n')
    write_file(folder, "c.csv", "campaign_type,,,campaign_name,campaign_id\nSearch,1,2,Two nameless,C003\n")
    write_file(folder, "d.csv", "campaign_name,campaign_type,campaign_id\n")
    write_file(folder, "e.csv", "")
    got = read_raw_sources_of(spark, os.path.dirname(folder), "marketing_campaigns")
    assert got.columns == list(RAW_COLUMNS["marketing_campaigns"])
    assert sorted(map(tuple, got.collect())) == [
        ("C001", "Spring", "Social"), ("C002", "Late, long", "Video"), ("C003", "Two nameless", "Search"),
    ]
    single = os.path.join(scratch, "single")
    write_file(single, "marketing_spend.csv", "spend,date,campaign_id\n1.5,2024-01-02,C1\n")
    assert tuple(read_raw_sources_of(spark, single, "marketing_spend").first()) == ("2024-01-02", "C1", "1.5")


def read_raw_sources_of(spark, base, name):
    from cohortlens.sources.readers import read_raw

    return read_raw(spark, base, name)


@pytest.mark.parametrize("header, told", [
    ("campaign_id,campaign_type", "campaign_name"), ("foo,bar,baz", "campaign_id, campaign_name, campaign_type"),
    ("campaign_id,campaign_name,campaign_type,CAMPAIGN_ID", "more than once: campaign_id"), ("", "campaign_id"),
])
def test_csv_without_a_column_raises(spark, scratch, header, told):
    folder = os.path.join(scratch, "raw")
    write_file(folder, "marketing_campaigns.csv", header + ("\nC1,a,b,c\n" if header else ""))
    with pytest.raises(ValueError, match=told):
        read_raw_sources_of(spark, folder, "marketing_campaigns")


def test_a_csv_replaced_after_its_header_was_read_fails(spark, scratch):
    folder = os.path.join(scratch, "raw")
    write_file(folder, "x.csv", "a,b\n1,2\n")
    rows = read_csv_by_name(spark, folder, ("a", "b"))
    write_file(folder, "x.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        rows.collect()


def test_write_outputs_to_catalog(spark):
    from cohortlens.sources.sinks import register_views, write_outputs

    a = spark.createDataFrame([("started_trial", 0.5)], "target string, roc_auc double")
    write_outputs({"model_metrics": a}, database="model_output_t")
    write_outputs({"model_metrics": a.union(a)}, database="model_output_t")  # replaced, not appended
    assert spark.table("model_output_t.model_metrics").count() == 2
    register_views({"mm": spark.table("model_output_t.model_metrics")})
    assert spark.sql("SELECT count(*) AS n FROM mm").first().n == 2
    lost = a.withColumn("roc_auc", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_outputs({"threshold_metrics": a, "model_metrics": lost}, database="model_output_t")
    assert spark.table("model_output_t.model_metrics").count() == 2
    assert not spark.catalog.tableExists("model_output_t.threshold_metrics")


def test_schema_profile_and_typed_raw(spark):
    from cohortlens.plans.profile import profile_schema
    from cohortlens.sources.readers import typed_raw

    raw = spark.createDataFrame(
        [("2024-01-02", "C001", "12.5")], "date string, campaign_id string, spend string"
    )
    typed = typed_raw(raw, "marketing_spend")
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["date", "string", "double"]
    rows = {r.column_name: r.data_type for r in profile_schema(typed, "marketing_spend").collect()}
    assert rows == {"date": "date", "campaign_id": "string", "spend": "double"}
