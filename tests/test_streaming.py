"""Scheduled refresh: new raw files are ingested once, models rebuilt."""

import os

import pytest

from cohortlens.sources import fixtures, tables
from cohortlens.streaming.scheduled import ingest_new_files, scheduled_refresh

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_available_now_ingestion_and_rebuild(spark, scratch):
    raw = fixtures.raw_sources(spark, SF)
    landing = os.path.join(scratch, "landing")
    for name, df in raw.items():
        df.coalesce(1).write.mode("append").option("header", True).csv(os.path.join(landing, name))
    warehouse = os.path.join(scratch, "wh")
    built = scheduled_refresh(spark, landing, warehouse)
    assert built.fct_user_journey.count() == 200
    # a second run with no new files appends nothing
    store = ingest_new_files(spark, landing, "user_activity", os.path.join(warehouse, "raw"), os.path.join(warehouse, "_checkpoints"))
    assert store.read("user_activity").count() == raw["user_activity"].count()


def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_ingestion_goes_by_header_and_survives_failures(spark, scratch, monkeypatch):
    landing, raw, checkpoints = (os.path.join(scratch, n) for n in ("landing", "raw", "checkpoints"))
    folder = os.path.join(landing, "marketing_spend")

    def ingest():
        return sorted(map(tuple, ingest_new_files(spark, landing, "marketing_spend", raw, checkpoints).read("marketing_spend").collect()))

    land(folder, "1.csv", "date,campaign_id,spend\n2024-01-01,C1,1\n")
    land(folder, "2.csv", "spend,extra,campaign_id,date\n2,x,C2,2024-01-02\n")
    two = [("2024-01-01", "C1", "1"), ("2024-01-02", "C2", "2")]
    assert ingest() == two
    # the rows are written, the job dies before they are published: the next run loads the file once
    land(folder, "3.csv", "campaign_id,date,spend\nC3,2024-01-03,3\n")
    with monkeypatch.context() as m:
        m.setattr(tables.Store, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            ingest()
    assert sorted(map(tuple, tables.Store(spark, raw).read("marketing_spend").collect())) == two
    three = [*two, ("2024-01-03", "C3", "3")]
    assert ingest() == three and ingest() == three
    # a file without a column stops the run; mended, it is loaded
    land(folder, "4.csv", "campaign_id,date\nC4,2024-01-04\n")
    with pytest.raises(ValueError, match="spend"):
        ingest()
    land(folder, "4.csv", "campaign_id,date,spend\nC4,2024-01-04,4\n")
    assert ingest() == [*three, ("2024-01-04", "C4", "4")]
