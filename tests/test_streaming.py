"""Two runs, replayed files, late rows, empty runs."""

import datetime as dt

from pyspark.sql import functions as F

from clinlake.plans import stages
from clinlake.sources import files
from clinlake.sources.bundles import read_bundles
from clinlake.streaming.tables import KeyedLog, append_stream, batch_writer, drain, write_clustered

BUNDLE = (
    '{"resourceType":"Bundle","type":"collection","entry":[{"fullUrl":"urn:uuid:p%s","resource":{"resourceType":"Patient","id":"%s",'
    '"meta":{"lastUpdated":"2024-01-0%sT00:00:00"},"birthDate":"1990-01-01","name":[{"family":"F%s","given":["G"]}],'
    '"identifier":[{"system":"m","value":"K%s","type":{"coding":[{"code":"MR"}]}}]}},'
    '{"fullUrl":"urn:uuid:e%s","resource":{"resourceType":"Encounter","id":"e%s","status":"finished","class":{"code":"AMB"},'
    '"period":{"start":"2024-02-01T00:00:00","end":"2024-02-01T02:00:00"},"subject":{"reference":"urn:uuid:p%s"}}}]}'
)


def put(folder, name, key, day, family):
    (folder / name).write_text(BUNDLE % (key, key, day, family, key, key, key, key))


def test_stage_run_is_incremental_and_idempotent(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    put(source, "a.json", "1", 1, "Old")
    (source / "broken.json").write_text("no json")
    lake = stages.run(spark, str(source), str(tmp_path / "lake"))

    def patients():
        return {r.patient_natural_key: r.family_name for r in lake.mart(spark, "dim_patient").collect()}

    assert patients() == {"K1": "FOld"}
    versions = lake.resources.versions(spark).count()
    stages.run(spark, str(source), str(tmp_path / "lake"), lake)
    assert lake.resources.versions(spark).count() == versions
    put(source, "b.json", "1", 2, "New")
    put(source, "c.json", "2", 1, "Two")
    stages.run(spark, str(source), str(tmp_path / "lake"), lake)
    assert patients() == {"K1": "FNew", "K2": "FTwo"}
    fact = lake.mart(spark, "fact_encounter")
    assert fact.count() == 2 and {r.length_of_stay_hours for r in fact.collect()} == {2.0}
    fresh = stages.run(spark, str(source), str(tmp_path / "lake"), lake, full_refresh=True)
    assert fresh.root != lake.root and fresh.resources.versions(spark).count() == 6


def test_edited_file_gets_a_new_id(spark, tmp_path):
    put(tmp_path, "a.json", "1", 1, "x")
    one = read_bundles(spark, str(tmp_path), streaming=False).first().bundle_uuid
    assert one == read_bundles(spark, str(tmp_path), streaming=False).first().bundle_uuid
    import os

    os.utime(tmp_path / "a.json", (1, 1))
    assert one != read_bundles(spark, str(tmp_path), streaming=False).first().bundle_uuid


def test_keyed_log_late_rows_and_tombstones(spark, tmp_path):
    log = KeyedLog(str(tmp_path / "log"), ("k",), "s", "gone")
    schema = "k string, s int, v string, gone boolean"
    log.write_batch(spark.createDataFrame([("a", 5, "new", False), ("b", 1, "x", False)], schema), 0)
    log.write_batch(spark.createDataFrame([("a", 2, "late", False), ("b", 3, None, True)], schema), 1)
    log.write_batch(spark.createDataFrame([("a", 2, "late", False), ("b", 3, None, True)], schema), 1)  # retried batch
    assert log.versions(spark).count() == 4
    assert [(r.k, r.v) for r in log.current(spark).collect()] == [("a", "new")]
    kinds = {(r.k, r._change_type) for r in log.changes(spark, 1).collect()}
    assert ("b", "delete") in kinds
    small = log.compact(spark, str(tmp_path / "small"))
    assert small.current(spark).count() == 1


def test_track_land_and_purge(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for n in range(3):
        (source / f"f{n}.json").write_text(str(n))
    out, check = str(tmp_path / "t"), str(tmp_path / "c")
    append_stream(files.track_files(spark, str(source), str(target)), out, check)
    (source / "f9.json").write_text("9")
    append_stream(files.track_files(spark, str(source), str(target)), out, check)
    tracker = spark.read.parquet(out)
    assert tracker.count() == 4 and tracker.where("file_moved").count() == 4
    assert sorted(p.name for p in target.iterdir()) == ["f0.json", "f1.json", "f2.json", "f9.json"]
    again = files.track_files(spark, str(source), str(target), streaming=False).collect()
    assert {r.message for r in again} == {"SKIPPED (exists)"}
    later = dt.datetime.now() + dt.timedelta(days=40)
    assert files.clean_source(spark, str(source), tracker, later).count() == 4
    assert len(list(source.iterdir())) == 4
    files.clean_source(spark, str(source), tracker, later, dry_run=False).collect()
    assert list(source.iterdir()) == []


def test_land_flat_folder(spark, tmp_path):
    source = tmp_path / "flat"
    source.mkdir()
    (source / "2024-01-01T00Z_patients.csv").write_text("x")
    (source / "notes.csv").write_text("y")
    files.land_flat(spark, str(source), str(tmp_path / "landing")).collect()
    assert (tmp_path / "landing" / "patients" / "2024-01-01T00Z_patients.csv").exists()
    assert not (tmp_path / "landing" / "notes").exists()


def test_plain_batch_sink_and_layout(spark, tmp_path):
    source = str(tmp_path / "src")
    spark.range(100).withColumn("k", F.when(F.col("id") < 40, 1).otherwise(F.col("id"))).write.parquet(source)
    stream = spark.readStream.schema("id long, k long").parquet(source)
    drain(stream.writeStream.foreachBatch(batch_writer(str(tmp_path / "dst"), lambda b: b.where("id % 2 = 0"))), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "dst")).count() == 50
    write_clustered(spark.read.parquet(source), str(tmp_path / "laid"), ["k"], 4)
    laid = spark.read.parquet(str(tmp_path / "laid"))
    hot = laid.where("k = 1").select(F.col("_metadata.file_name")).distinct().count()
    assert laid.count() == 100 and hot > 1


NAMES = ["a b.json", "a#b.json", "a%20b.json", "a?b.json", "ü.json", "a.json", "sub/a.json"]


def put_names(folder):
    for name in NAMES:
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(name)


def test_names_are_taken_letter_by_letter(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    put_names(source)
    rows = files.track_files(spark, str(source), str(target), streaming=False).collect()
    assert {r.message for r in rows} == {"MOVED"} and len(rows) == len(NAMES)
    assert all((target / name).read_text() == name for name in NAMES)
    assert sum(p.is_file() for p in target.rglob("*")) == len(NAMES)


def test_edited_files_land_again(spark, tmp_path):
    import os

    source, target = tmp_path / "in", tmp_path / "out"
    put_names(source)
    files.track_files(spark, str(source), str(target), streaming=False).collect()
    (source / "a.json").write_text("longer than before")
    (source / "ü.json").write_text("Ü.json")
    os.utime(source / "ü.json", (4_000_000_000, 4_000_000_000))
    again = {r.source_path.rsplit("/in/", 1)[1]: r.message for r in files.track_files(spark, str(source), str(target), streaming=False).collect()}
    assert {n for n, m in again.items() if m == "MOVED"} == {"a.json", "ü.json"}
    assert (target / "a.json").read_text() == "longer than before" and (target / "sub/a.json").read_text() == "sub/a.json"


def test_source_stays_until_its_copy_is_whole(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    put_names(source)
    tracker = files.track_files(spark, str(source), str(target), streaming=False)
    tracker.write.parquet(str(tmp_path / "tracker"))
    tracker = spark.read.parquet(str(tmp_path / "tracker"))
    (source / "a.json").write_text("edited since")
    (target / "a b.json").unlink()
    (target / "a#b.json").write_text("cut")
    later = dt.datetime.now() + dt.timedelta(days=40)
    files.clean_source(spark, str(source), tracker, later, dry_run=False).collect()
    assert sorted(str(p.relative_to(source)) for p in source.rglob("*") if p.is_file()) == ["a b.json", "a#b.json", "a.json"]


def test_purge_deletes_the_named_file(spark, tmp_path):
    import os

    put_names(tmp_path)
    os.utime(tmp_path / "a#b.json", (1_000_000, 1_000_000))
    os.utime(tmp_path / "a?b.json", (1_000_000, 1_000_000))
    rows = files.purge_old_files(spark, str(tmp_path), 30, dt.datetime.now(), dry_run=False).collect()
    assert len(rows) == 2 and all(r.deleted for r in rows)
    assert {n for n in NAMES if not (tmp_path / n).exists()} == {"a#b.json", "a?b.json"}


def test_failed_copy_leaves_nothing(spark, tmp_path):
    (tmp_path / "out" / "a.json").mkdir(parents=True)
    (tmp_path / "out" / "a.json" / "x").write_text("a folder is in the way")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("1")
    row = files.track_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), streaming=False).collect()[0]
    assert not row.file_moved and row.message not in files.LANDED
    assert not list((tmp_path / "out").glob("*.partial")) and not list((tmp_path / "out").glob("._*"))


def test_two_sources_with_one_target(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / "in" / folder / "run1" / "csv").mkdir(parents=True)
        (tmp_path / "in" / folder / "run1" / "csv" / "patients.csv").write_text(folder)
    rows = files.land_by_type(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    assert sorted(r.message.split(" ")[0] for r in rows) == ["CONFLICT", "MOVED"]
    assert (tmp_path / "out" / "patients" / "run1_patients.csv").read_text() == "x"


def test_changes_of_late_rows(spark, tmp_path):
    log = KeyedLog(str(tmp_path / "log"), ("k",), "s")
    out, checkpoint = str(tmp_path / "changes"), str(tmp_path / "ck")
    batches = [[("a", 5, "first")], [("a", 2, "late")], [("a", 5, "tie"), ("b", 1, "x")], [("a", 9, "last"), (None, 1, "n")]]
    for n, rows in enumerate(batches):
        log.write_batch(spark.createDataFrame(rows, "k string, s int, v string"), n)
        log.change_stream(spark, out, checkpoint)
    want = [
        ("None", 3, "insert", "n"), ("a", 0, "insert", "first"), ("a", 2, "update_postimage", "tie"), ("a", 2, "update_preimage", "first"),
        ("a", 3, "update_postimage", "last"), ("a", 3, "update_preimage", "tie"), ("b", 2, "insert", "x"),
    ]
    for rows in (log.changes(spark), spark.read.parquet(out)):
        assert sorted((str(r.k), r._commit_version, r._change_type, r.v) for r in rows.collect()) == want


def test_nothing_is_dropped_without_a_side_table(spark, tmp_path):
    """Files in = bundles read + rejected; entries in = resources + entries aside; gold rows likewise."""
    source = tmp_path / "in"
    source.mkdir()
    put(source, "a.json", "1", 1, "A")
    (source / "broken.json").write_text("no json")
    (source / "empty.json").write_text('{"resourceType":"Bundle","entry":[]}')
    (source / "bare.json").write_text(
        '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Patient","id":"9"}},{"fullUrl":"urn:uuid:x","resource":{"id":"8"}},'
        '{"fullUrl":"urn:uuid:e7","resource":{"resourceType":"Encounter","id":"e7","status":"finished","subject":{"reference":"urn:uuid:nobody"}}},'
        '{"fullUrl":"urn:uuid:p6","resource":{"resourceType":"Patient","id":"6","identifier":[{"system":"s","type":{"coding":[{"code":"DL"}]}}]}}]}'
    )
    lake = stages.run(spark, str(source), str(tmp_path / "lake"))
    aside = lambda name: spark.read.parquet(lake.aside(name))
    assert {r.reason: r["count"] for r in aside("bundles").groupBy("reason").count().collect()} == {"malformed": 1, "no entries": 1}
    assert aside("bundles").where("value = 'no json'").count() == 1
    assert {r.reason for r in aside("entries").collect()} == {"no url", "no type"}
    assert spark.read.parquet(lake.table("bundles")).count() == 4
    assert lake.resources.versions(spark).count() + aside("entries").count() == 2 + 4
    assert aside("encounter_gold_unresolved").count() == 1
    patients = spark.read.parquet(lake.table("silver/patient")).count()
    known = lake.gold("patient_gold", ("patient_natural_key",)).versions(spark).count()
    assert patients == 2 and known + aside("patient_gold_keyless").count() + aside("patient_gold_bare").count() == patients
    encounters = spark.read.parquet(lake.table("silver/encounter")).count()
    gold = lake.gold("encounter_gold", ("encounter_natural_key",)).versions(spark).count()
    assert gold + aside("encounter_gold_failed").count() + aside("encounter_gold_keyless").count() == encounters
    assert aside("encounter_gold_rules").select("rule").distinct().count() == len(stages.gold_rules()["encounter_gold"])
