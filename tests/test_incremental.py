"""Batch limits, the mart kept up by change rows, history by batch."""

import random

import pytest
from pyspark.sql import functions as F

from clinlake.operators.current import scd2
from clinlake.plans import csv_run, stages
from clinlake.sources.limits import BatchLimit
from clinlake.streaming.history import HistoryLog
from clinlake.streaming.tables import KeyedLog, drain, stream_of
from tests.test_streaming import put

PRACTITIONER = (
    '{"resourceType":"Bundle","entry":[{"fullUrl":"urn:uuid:d%s","resource":{"resourceType":"Practitioner","id":"d%s","meta":{"lastUpdated":"2024-01-0%sT00:00:00"},'
    '"identifier":[{"system":"http://hl7.org/fhir/sid/us-npi","value":"N%s"}],"name":[{"family":"Doc"}]}},'
    '{"fullUrl":"urn:uuid:o1","resource":{"resourceType":"Organization","id":"o1","name":"Org"}},'
    '{"fullUrl":"urn:uuid:l1","resource":{"resourceType":"Location","id":"l1","name":"Loc","managingOrganization":{"reference":"urn:uuid:o1"}}}]}'
)


def with_doctor(folder, name, key, doctor):
    put(folder, name, key, 1, "F")
    text = (folder / name).read_text()
    reference = '"participant":[{"individual":{"reference":"urn:uuid:d%s"}}],"subject"' % doctor
    (folder / name).write_text(text.replace('"subject"', reference, 1))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_limits_are_checked():
    assert BatchLimit(files=1).files == 1
    for wrong in ({"files": 1, "size": 1}, {"files": 0}, {"size": -1}):
        with pytest.raises(ValueError):
            BatchLimit(**wrong)


def test_backlog_in_parts(spark, tmp_path):
    """n files in batches of k make ceil(n / k) batches and the same rows."""
    for n in range(7):
        spark.range(n * 10, n * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for name, limit, batches in (("a", BatchLimit(files=3), 3), ("b", BatchLimit(), 1), ("c", BatchLimit(size=1), 7)):
        log = KeyedLog(str(tmp_path / name), ("id",), "id")
        drain(stream_of(spark, str(tmp_path / "in"), limit).writeStream.foreachBatch(log.write_batch), str(tmp_path / f"check-{name}"))
        assert len(list((tmp_path / name).glob("batch_id=*"))) == batches
        assert log.current(spark).count() == 70
    assert KeyedLog(str(tmp_path / "a"), ("id",), "id").stream(spark, BatchLimit(files=1)).isStreaming


def test_run_goes_on_after_a_failure_between_batches(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(1, 6):
        put(source, f"{n}.json", str(n), 1, f"N{n}")
    put(source, "again.json", "2", 3, "Newer")
    whole = stages.run(spark, str(source), str(tmp_path / "whole"))
    lake = stages.Lakehouse.new_version(str(tmp_path / "parts"))
    write, seen = KeyedLog.write_batch, []

    def stops(self, batch, batch_id):
        if self.path.endswith("resources") and batch_id == 1 and not seen:
            seen.append(batch_id)
            raise RuntimeError("executor gone")
        write(self, batch, batch_id)

    monkeypatch.setattr(KeyedLog, "write_batch", stops)
    with pytest.raises(Exception, match="executor gone"):
        stages.run(spark, str(source), "", lake, limit=BatchLimit(files=2))
    assert [p.name for p in (tmp_path / "parts").glob("v-*/tables/resources/batch_id=*")] == ["batch_id=0"]
    stages.run(spark, str(source), "", lake, limit=BatchLimit(files=2))
    assert spark.read.parquet(lake.table("bundles")).select("ingest_time").distinct().count() == 3
    assert lake.resources.versions(spark).select("batch_id").distinct().count() > 1
    for name in ("dim_patient", "fact_encounter"):
        assert rows_of(lake.mart(spark, name).drop("resource_last_updated")) == rows_of(whole.mart(spark, name).drop("resource_last_updated"))


def test_csv_backlog_in_parts(spark, tmp_path):
    folder = tmp_path / "in" / "organizations"
    folder.mkdir(parents=True)
    head = "Id,NAME,ADDRESS,CITY,STATE,ZIP,LAT,LON,PHONE,REVENUE,UTILIZATION"
    for n in range(5):
        (folder / f"{n}.csv").write_text(f"{head}\nid{n % 3},Name{n},A,C,S,Z,1.0,2.0,P,3.0,{n}\n")
    for name, limit in (("whole", BatchLimit()), ("parts", BatchLimit(files=2))):
        csv_run.run(spark, str(tmp_path / "in"), str(tmp_path / name), ["organizations"], limit=limit)
    got, want = (spark.read.parquet(str(tmp_path / n / "raw" / "organizations")).select("value") for n in ("parts", "whole"))
    assert rows_of(got) == rows_of(want) and got.count() == 5
    assert spark.read.parquet(str(tmp_path / "parts" / "raw" / "organizations")).select("ingest_time").distinct().count() == 3


def test_mart_by_change_rows(spark, tmp_path):
    """The second run writes the keys of its own bundle only, and late dimensions reach facts that refer to them."""
    source, base = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    when = F.lit("2030-01-01").cast("timestamp")
    as_of = F.lit("2025-01-01").cast("date")
    (source / "dims.json").write_text(PRACTITIONER % (1, 1, 1, 1))
    with_doctor(source, "a.json", "1", 1)
    with_doctor(source, "b.json", "2", 2)
    lake = stages.run(spark, str(source), base, batch_time=when, rebuild_mart=False)
    log = lake.mart_log

    def facts():
        return {r.patient_natural_key: r.practitioner_natural_key for r in log.table(spark, "fact_encounter").collect()}

    assert facts() == {"K1": "N1", "K2": None} and log.progress(spark)[0] == 1
    stages.run(spark, str(source), base, lake, batch_time=when, rebuild_mart=False)
    assert log.progress(spark)[0] == 1  # nothing new, nothing written
    with_doctor(source, "c.json", "3", 1)
    put(source, "d.json", "1", 5, "Renamed")
    stages.run(spark, str(source), base, lake, batch_time=when, rebuild_mart=False)
    second = log.written(spark, "dim_patient").where("run = 2")
    assert {r.patient_natural_key for r in second.collect()} == {"K1", "K3"}
    assert {r.patient_natural_key for r in log.written(spark, "fact_encounter").where("run = 2").collect()} <= {"K1", "K3"}
    (source / "e.json").write_text(PRACTITIONER % (2, 2, 2, 2))
    stages.run(spark, str(source), base, lake, batch_time=when, rebuild_mart=False)
    assert facts()["K2"] == "N2"
    assert {r.patient_natural_key for r in log.written(spark, "fact_encounter").where("run = 3").collect()} == {"K2"}
    whole = stages.run(spark, str(source), base, lake, batch_time=when, as_of=as_of)
    for name in ("dim_patient", "dim_practitioner", "dim_organization", "dim_location", "fact_encounter"):
        assert rows_of(log.table(spark, name, as_of)) == rows_of(whole.mart(spark, name)), name


def test_an_unfinished_run_is_written_anew(spark, tmp_path, monkeypatch):
    from clinlake.plans.mart_log import MartLog

    gold = KeyedLog(str(tmp_path / "gold"), ("immunization_natural_key",), "resource_last_updated")
    shape = "immunization_natural_key string, patient_natural_key string, vaccine_code string, vaccine_display string, status string, occurrence_datetime string, resource_last_updated int, resource string"
    gold.write_batch(spark.createDataFrame([("a", "p", "1", "x", "s", "t", 5, ""), ("b", "p", "1", "x", "s", "t", 5, "")], shape), 0)
    log = MartLog(str(tmp_path / "mart"))
    assert log.refresh(spark, {"immunization_gold": gold}) == 1
    gold.write_batch(spark.createDataFrame([("a", "p", "late", "x", "s", "t", 4, ""), ("b", None, "2", "x", "s", "t", 6, ""), ("c", "p", "tie", "x", "s", "t", 5, "")], shape), 1)
    monkeypatch.setattr(MartLog, "_encounters", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        log.refresh(spark, {"immunization_gold": gold})
    codes = lambda: {r.immunization_natural_key: r.vaccine_code for r in log.table(spark, "fact_immunization").collect()}
    assert codes() == {"a": "1", "b": "1"}
    monkeypatch.undo()
    assert log.refresh(spark, {"immunization_gold": gold}) == 2
    assert codes() == {"a": "1", "c": "tie"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_by_batch(spark, tmp_path, seed):
    """Any order of drops gives what all rows at once give, surrogate keys included."""
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), r.choice([1, None]), r.randint(1, 14), r.choice(["x", "y", None]), r.choice(["m", "n"])) for _ in range(40)]
    shape = "k string, j int, s int, v string, note string"
    log = HistoryLog(str(tmp_path / "h"), ("k", "j"), "s", ("v",))
    for n in range(4):
        part = spark.createDataFrame(rows[n * 10 : n * 10 + 10], shape)
        log.write_batch(part, n)
        if n == 2:
            log.write_batch(part, n)  # a retried batch
        want = scd2(spark.createDataFrame(rows[: n * 10 + 10], shape), ["k", "j"], "s", ["v"])
        assert rows_of(log.current(spark).select(*want.columns)) == rows_of(want)
    log.write_batch(spark.createDataFrame([], shape), 4)
    log.write_batch(spark.createDataFrame([("z", 1, 1, "x", "m")], shape), 5)
    assert {row.k for row in log.versions(spark).where("batch_id = 5").collect()} == {"z"}
