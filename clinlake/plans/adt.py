"""ADT messages: patient pool, event journeys, HL7 segments, message table, parser.

Everything is a Column expression: attributes come from seeded hash draws, event
plans from array expressions, segments from field-position maps. The whole job
from pool to message text is one narrow stage without Python workers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions.keys import generated_key, seeded_draw
from clinlake.operators.current import merge_upsert, scd1
from clinlake.operators.links import left_lookup

# Code lists of the messages.
RACES = [("2106-3", 60), ("2054-5", 20), ("2028-9", 10), ("2076-8", 5), ("1002-5", 5)]
MARITAL = [("M", 45), ("S", 30), ("D", 15), ("W", 7), ("A", 3)]
RELIGIONS = [("CAT", 25), ("BAP", 15), ("PRO", 20), ("JEW", 5), ("MOS", 3), ("OTH", 12), ("NON", 20)]
SERVICES = [
    ("MED", 30), ("SUR", 20), ("OBS", 15), ("CAR", 10), ("NEU", 8), ("ONC", 7), ("ORT", 5), ("PSY", 3), ("PED", 2),
]
DIAGNOSES = [
    ("E11.9", "Type 2 diabetes mellitus without complications"),
    ("I10", "Essential hypertension"),
    ("J44.9", "COPD, unspecified"),
    ("I25.10", "Atherosclerotic heart disease"),
    ("N18.3", "Chronic kidney disease, stage 3"),
    ("J18.9", "Pneumonia, unspecified"),
    ("I50.9", "Heart failure, unspecified"),
    ("K21.9", "Gastro-esophageal reflux disease"),
    ("M25.50", "Pain in unspecified joint"),
    ("E78.5", "Hyperlipidemia, unspecified"),
    ("F32.9", "Major depressive disorder"),
    ("M54.5", "Low back pain"),
    ("I63.9", "Cerebral infarction, unspecified"),
    ("J96.00", "Acute respiratory failure"),
    ("N39.0", "Urinary tract infection"),
]
DIAGNOSIS_TYPES = ["A", "W", "F"]
ALLERGENS = {
    "DA": ["1191^Aspirin", "7980^Penicillin", "203^Ibuprofen", "1605^Codeine", "1272^Morphine"],
    "FA": ["F01^Peanuts", "F02^Shellfish", "F03^Eggs", "F04^Milk", "F05^Soy"],
    "MA": ["M01^Latex", "M02^Contrast dye", "M03^Adhesive tape"],
    "EA": ["E01^Pollen", "E02^Dust mites", "E03^Pet dander"],
}
SEVERITIES = ["MI", "MO", "SV"]
REACTIONS = ["Rash", "Hives", "Itching", "Swelling", "Anaphylaxis", "Nausea", "Vomiting"]
ADMIT_REASONS = [
    "Chest pain", "Shortness of breath", "Abdominal pain", "Fever", "Trauma",
    "Scheduled surgery", "Weakness", "Altered mental status", "Fall", "Syncope",
]
INSURERS = ["Blue Cross", "Aetna", "UnitedHealth", "Cigna", "Humana", "Kaiser", "Medicare", "Medicaid"]
PLAN_TYPES = ["HMO", "PPO", "EPO", "POS"]
ALLERGY_PERCENT = 30
HISPANIC_PERCENT = 18

# Our own short word lists for names and places.
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gina", "Hugo", "Iris", "Jon", "Kim", "Leo", "Mia", "Ned", "Ola", "Pia"]
LAST_NAMES = ["Abbott", "Baker", "Carver", "Dunn", "Ellis", "Frost", "Grant", "Hale", "Irwin", "Joyce", "Keller", "Lowe", "Marsh", "Nolan", "Owens", "Price"]
STREETS = ["Oak St", "Elm Ave", "Hill Rd", "Lake Dr", "Mill Ln", "Park Blvd", "River Way", "Station Rd"]
CITIES = ["Ashford", "Brookfield", "Clayton", "Dover", "Easton", "Fairview", "Georgetown", "Hudson"]
STATES = ["CA", "CO", "FL", "GA", "IL", "MA", "NY", "OH", "PA", "TX", "VA", "WA"]
ID_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

DEFAULT_SENDER = {
    "sending_app": "SyntheticEHR",
    "sending_facility": "TestHospital",
    "receiving_app": "DataPlatform",
    "receiving_facility": "Analytics",
    "hl7_version": "2.5",
}


def _choice(values: Sequence[str], draw: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), draw + 1)


def _weighted(weights: Sequence[tuple[str, int]], roll: Column, default: str) -> Column:
    """Value whose cumulative percentage covers ``roll`` (0..99)."""
    total, out = 0, None
    for value, weight in weights:
        total += weight
        out = F.when(roll < total, value) if out is None else out.when(roll < total, value)
    return out.otherwise(default)


def patient_pool(keys: DataFrame, key: str = "id", seed: int = 0, as_of: str = "2026-01-01", reuse: DataFrame | None = None) -> DataFrame:
    """One synthetic patient per key row, every attribute a repeatable draw.

    ``reuse`` holds ``patient_id`` values that get a further visit: they are added
    with their own id and fresh attributes.
    """
    fresh = _attributes(keys.select(F.col(key).cast("long").alias("_key")), seed, as_of, None)
    if reuse is None:
        return fresh
    known = reuse.select("patient_id").distinct()
    known = known.withColumn("_key", F.pmod(F.xxhash64("patient_id"), F.lit(1 << 40)))
    return _attributes(known, seed + 50_000, as_of, "patient_id").unionByName(fresh)


def _attributes(rows: DataFrame, seed: int, as_of: str, known_id: str | None) -> DataFrame:
    key = F.col("_key")

    def draw(salt: str, n: int) -> Column:
        return seeded_draw(key, salt, n, seed)

    def digits(salt: str, width: int) -> Column:
        return F.lpad(draw(salt, 10**width).cast("string"), width, "0")

    def phone(salt: str) -> Column:
        return F.concat_ws("-", digits(salt + "a", 3), digits(salt + "b", 3), digits(salt + "c", 4))

    def letters(salt: str, n: int) -> Column:
        return F.concat(*[F.substring(F.lit(ID_LETTERS), draw(f"{salt}{i}", 36) + 1, F.lit(1)) for i in range(n)])

    def day(offset: Column, pattern: str) -> Column:
        return F.date_format(F.date_add(F.lit(as_of).cast("date"), offset), pattern)

    base = rows.withColumns(
        {
            "first_name": _choice(FIRST_NAMES, draw("first", len(FIRST_NAMES))),
            "last_name": _choice(LAST_NAMES, draw("last", len(LAST_NAMES))),
            "dob": day(-(draw("dob", 72 * 365) + 18 * 366), "yyyyMMdd"),
            "visit_id": F.concat(F.lit("VIS"), day(-draw("visit", 31), "yyMMdd"), letters("visit", 4)),
            "sex": F.when(key % 2 == 0, "M").otherwise("F"),
            "ssn": F.concat_ws("-", (draw("ssna", 800) + 100).cast("string"), (draw("ssnb", 90) + 10).cast("string"), (draw("ssnc", 9000) + 1000).cast("string")),
            "street_address": F.concat_ws(" ", (draw("house", 999) + 1).cast("string"), _choice(STREETS, draw("street", len(STREETS)))),
            "city": _choice(CITIES, draw("city", len(CITIES))),
            "state": _choice(STATES, draw("state", len(STATES))),
            "zipcode": digits("zip", 5),
            "country": F.lit("USA"),
            "phone": phone("phone"),
            "race": _weighted(RACES, draw("race", 100), "2106-3"),
            "marital_status": _weighted(MARITAL, draw("marital", 100), "M"),
            "religion": _weighted(RELIGIONS, draw("religion", 100), "OTH"),
            "ethnic_group": F.when(draw("ethnic", 100) < HISPANIC_PERCENT, "H").otherwise("N"),
            "birth_place": F.concat_ws(", ", _choice(CITIES, draw("bcity", len(CITIES))), _choice(STATES, draw("bstate", len(STATES)))),
            "nok_first_name": _choice(FIRST_NAMES, draw("nokfirst", len(FIRST_NAMES))),
            "nok_last_name": _choice(LAST_NAMES, draw("noklast", len(LAST_NAMES))),
            "nok_phone": phone("nokphone"),
            "nok_relationship": F.when(key % 3 == 0, "SPO").when(key % 3 == 1, "CHD").otherwise("PAR"),
            "_diagnosis": draw("diagnosis", len(DIAGNOSES)),
            "diagnosis_type": _choice(DIAGNOSIS_TYPES, draw("dtype", 3)),
            "hospital_service": _weighted(SERVICES, draw("service", 100), "MED"),
            "has_allergies": F.when(draw("allergy", 100) < ALLERGY_PERCENT, "Y").otherwise("N"),
            "admit_reason": _choice(ADMIT_REASONS, draw("reason", len(ADMIT_REASONS))),
            "insurance_company": _choice(INSURERS, draw("insurer", len(INSURERS))),
            "insurance_company_id": F.concat(F.lit("INS"), F.lpad((key % 100).cast("string"), 3, "0")),
            "insurance_id": letters("policy", 12),
            "insurance_group": F.concat(F.lit("GRP"), (draw("group", 90000) + 10000).cast("string")),
            "insurance_plan_id": F.concat(F.lit("PLAN"), (draw("plan", 9000) + 1000).cast("string")),
            "insurance_plan_type": _choice(PLAN_TYPES, draw("plantype", len(PLAN_TYPES))),
            "insurance_effective_date": day(-draw("effective", 731), "yyyyMMdd"),
            "insurance_expiration_date": day(draw("expires", 366), "yyyyMMdd"),
            "journey_draw": draw("journey", 1000),
        }
    )
    new_id = F.concat(
        F.upper(F.concat(F.substring("last_name", 1, 2), F.substring("first_name", 1, 1))),
        (key + 100_000).cast("string"),
    )
    allergic = F.col("has_allergies") == "Y"
    base = base.withColumns(
        {
            "patient_id": F.col(known_id) if known_id else new_id,
            "diagnosis_code": _choice([c for c, _ in DIAGNOSES], F.col("_diagnosis")),
            "diagnosis_desc": _choice([d for _, d in DIAGNOSES], F.col("_diagnosis")),
            "has_allergy2": F.when(allergic & (key % 2 == 0), "Y").otherwise("N"),
        }
    )
    for n, present in ((1, allergic), (2, F.col("has_allergy2") == "Y")):
        kind = _choice(list(ALLERGENS), draw(f"a{n}type", len(ALLERGENS)))
        named = F.lit(None).cast("string")
        for code, items in ALLERGENS.items():
            named = F.when(F.col(f"allergy{n}_type") == code, _choice(items, draw(f"a{n}item", len(items)))).otherwise(named)
        base = base.withColumn(f"allergy{n}_type", F.when(present, kind)).withColumns(
            {
                f"allergy{n}_code_desc": F.when(present, named),
                f"allergy{n}_severity": F.when(present, _choice(SEVERITIES, draw(f"a{n}severity", 3))),
                f"allergy{n}_reaction": F.when(present, _choice(REACTIONS, draw(f"a{n}reaction", len(REACTIONS)))),
            }
        )
    return base.withColumnRenamed("_key", "patient_index").drop("_diagnosis")


def sample_patients(messages: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """``k`` patients picked at random but repeatably, with their first visit id."""
    firsts = messages.groupBy("patient_id").agg(F.min_by("visit_id", F.struct("event_order", "visit_id")).alias("visit_id"))
    return firsts.orderBy(F.xxhash64("patient_id", F.lit(seed)), "patient_id").limit(k)


def _codes(*codes: str) -> Column:
    return F.array(*[F.lit(c) for c in codes])


def _times(code: str, n: Column) -> Column:
    return F.array_repeat(F.lit(code), n.cast("int"))


def journey_plan(r: Column) -> Column:
    """Ordered event codes of a journey drawn as a number in 0..999.

    0 emergency to inpatient, 1 transfers, 2 cancelled admission, 3 cancelled
    transfer, 4 cancelled discharge, 5 emergency only, 6 inpatient to outpatient,
    7-9 ordinary stay with updates and transfers.
    """

    def part(divisor: int, modulus: int) -> Column:
        return F.floor(r / divisor) % modulus

    empty = F.array().cast("array<string>")
    discharge = _codes("A03")
    routes: Mapping[int, Column] = {
        0: F.concat(_codes("A04", "A06"), _times("A08", part(10, 3)), discharge),
        1: F.concat(_codes("A01"), _times("A02", part(20, 2) + 1), discharge),
        2: _codes("A01", "A11"),
        3: _codes("A01", "A02", "A12", "A02", "A03"),
        4: _codes("A01", "A08", "A03", "A13", "A08", "A03"),
        5: F.concat(_codes("A04"), F.when(part(50, 2) == 0, _codes("A08")).otherwise(empty)),
        6: _codes("A01", "A08", "A07", "A03"),
    }
    stay = F.concat(
        _codes("A01"), _times("A08", r % 4), _times("A02", part(4, 3)), F.when(r % 5 != 0, discharge).otherwise(empty)
    )
    out = None
    for kind, route in routes.items():
        out = F.when(r % 10 == kind, route) if out is None else out.when(r % 10 == kind, route)
    return out.otherwise(stay)


def explode_events(pool: DataFrame, draw: str = "journey_draw") -> DataFrame:
    """One row per planned event with its order and the first event of the journey."""
    planned = pool.withColumn("_plan", journey_plan(F.col(draw)))
    return planned.select(
        *[c for c in pool.columns if c != draw],
        F.get("_plan", F.lit(0)).alias("_first_event"),
        F.posexplode("_plan").alias("event_order", "event_type"),
    )


def patient_class(event_type: Column) -> Column:
    return (
        F.when(event_type == "A04", "E")
        .when(event_type.isin("A06", "A01", "A02", "A03", "A11", "A12", "A13"), "I")
        .otherwise("O")
    )


def event_timing(events: DataFrame, base: str = "2026-01-01 00:00:00") -> DataFrame:
    """Event and visit times, class, location, doctor.

    The admission time is the time of the journey's first event. It follows from
    the patient id and the plan, so no window over the patient is needed; the
    general form for given messages is ``admit_times``.
    """
    shift = F.pmod(F.hash("patient_id"), F.lit(24))
    start = F.unix_timestamp(F.lit(base).cast("timestamp"))
    stamp = "yyyyMMddHHmmss"

    def at(hours: Column) -> Column:
        return F.timestamp_seconds(start + hours * 3600)

    def padded(column: str, n: int, width: int) -> Column:
        return F.lpad(F.pmod(F.hash(column), F.lit(n)).cast("string"), width, "0")

    admitted = F.col("_first_event").isin("A01", "A04")
    stay_days = F.lit(3) + F.abs(F.hash("patient_id").cast("long")) % 5
    kind = F.col("event_type")
    when = F.date_format(at(F.col("event_order") * 2 + shift), stamp)
    return events.withColumns(
        {
            "event_datetime": when,
            "msg_datetime": when,
            "msg_control_id": F.concat(
                F.lit("MSG"),
                F.substring(F.md5(F.concat_ws("|", "patient_id", "visit_id", F.col("event_order").cast("string"))), 1, 12),
            ),
            "patient_class": patient_class(kind),
            "patient_location": F.concat(
                F.when(kind == "A04", "ER").otherwise("WARD"),
                padded("patient_id", 10, 2),
                F.lit("-ROOM"),
                padded("visit_id", 20, 2),
            ),
            "attending_dr_id": F.concat(F.lit("DR"), padded("patient_id", 50, 3)),
            "attending_dr_last": F.concat(F.lit("DOC"), padded("patient_id", 50, 3)),
            "attending_dr_first": F.lit("ATTENDING"),
            "discharge_datetime": F.when(kind == "A03", when).otherwise(""),
            "admit_datetime": F.when(admitted, F.date_format(at(shift), stamp)),
            "expected_discharge": F.when(
                admitted, F.date_format(at(shift + stay_days * 24), stamp)
            ).otherwise(""),
        }
    ).drop("_first_event")


def admit_times(events: DataFrame, keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """Attach the first event's time if it is an admission, else NULL.

    The first row decides even when it is not an admission. One pre-aggregated row
    per patient is joined back, so a busy patient is never gathered in one task.
    """
    value = F.when(F.col("event_type").isin("A01", "A04"), F.col("event_datetime"))
    firsts = events.groupBy(*keys).agg(
        F.min_by(F.struct(value.alias("v")), F.struct("event_order", "event_datetime", "event_type")).alias("_f")
    )
    linked = left_lookup(events, firsts, [(k, k) for k in keys])
    return linked.withColumn("admit_datetime", F.col("_f.v")).drop("_f")


def segment(name: str, fields: Mapping[int, Column | str], length: int) -> Column:
    """HL7 segment text from a field-number map; unnamed fields are empty.

    A NULL field makes the segment NULL, and assembly leaves it out.
    """
    parts: list[Column] = [F.lit(name)]
    for i in range(1, length + 1):
        value = fields.get(i, "")
        parts += [F.lit("|"), F.lit(value) if isinstance(value, str) else value]
    return F.concat(*parts)


def _components(*parts: Column | str) -> Column:
    """Components joined by ``^``."""
    out: list[Column] = []
    for p in parts:
        out += [F.lit("^"), F.lit(p) if isinstance(p, str) else p]
    return F.concat(*out[1:])


def _col(name: str) -> Column:
    return F.col(name)


def _name(last: str, first: str) -> Column:
    return _components(_col(last), _col(first), "")


def _address() -> Column:
    return _components(_col("street_address"), "", _col("city"), _col("state"), _col("zipcode"), "USA")


def _doctor() -> Column:
    return _components(_col("attending_dr_id"), _col("attending_dr_last"), _col("attending_dr_first"), "", "", "", "MD")


def segment_msh(sender: Mapping[str, str]) -> Column:
    # Field 1 of MSH is the separator itself, so positions are one lower than named.
    return segment(
        "MSH",
        {
            1: "^~\\&", 2: sender["sending_app"], 3: sender["sending_facility"], 4: sender["receiving_app"],
            5: sender["receiving_facility"], 6: _col("msg_datetime"), 8: _col("event_type"),
            9: _col("msg_control_id"), 10: "P", 11: sender["hl7_version"],
        },
        13,
    )


def segment_evn() -> Column:
    return segment("EVN", {1: _col("event_type"), 2: _col("event_datetime")}, 4)


def segment_pid() -> Column:
    return segment(
        "PID",
        {
            1: "1", 3: _components(_col("patient_id"), "", "", "MRN"), 5: _name("last_name", "first_name"),
            7: _col("dob"), 8: _col("sex"), 10: _col("race"), 11: _address(), 13: _col("phone"),
            16: _col("marital_status"), 17: _col("religion"), 21: _col("ssn"), 24: _col("ethnic_group"),
            25: _col("birth_place"),
        },
        27,
    )


def segment_nk1() -> Column:
    return segment(
        "NK1",
        {1: "1", 2: _components(_col("nok_last_name"), _col("nok_first_name")), 3: _col("nok_relationship"), 4: _col("nok_phone")},
        6,
    )


def segment_pv1() -> Column:
    return segment(
        "PV1",
        {
            1: "1", 2: _col("patient_class"), 3: _col("patient_location"), 6: _doctor(), 10: _col("hospital_service"),
            19: _doctor(), 52: _col("admit_datetime"), 53: _col("discharge_datetime"),
        },
        55,
    )


def segment_pv2() -> Column:
    return segment("PV2", {3: _col("admit_reason"), 8: _col("expected_discharge")}, 9)


def segment_dg1() -> Column:
    return segment(
        "DG1",
        {1: "1", 3: _components(_col("diagnosis_code"), _col("diagnosis_desc")), 5: _col("msg_datetime"), 6: _col("diagnosis_type")},
        8,
    )


def segment_al1() -> Column:
    """None, one or two allergy segments."""

    def one(n: int) -> Column:
        return segment(
            "AL1",
            {
                1: str(n), 2: _col(f"allergy{n}_type"), 3: _col(f"allergy{n}_code_desc"),
                4: _col(f"allergy{n}_severity"), 5: _col(f"allergy{n}_reaction"),
            },
            6,
        )

    first = F.when(_col("has_allergies") == "Y", one(1))
    second = F.when((_col("has_allergies") == "Y") & (_col("has_allergy2") == "Y"), one(2))
    return F.when(first.isNotNull(), F.concat_ws("\r", first, second))


def segment_gt1() -> Column:
    return segment(
        "GT1",
        {
            1: "1", 3: _name("last_name", "first_name"), 5: _address(), 6: _col("phone"), 9: _col("dob"),
            10: _col("sex"), 12: "01",
        },
        14,
    )


def segment_in1() -> Column:
    return segment(
        "IN1",
        {
            1: "1", 2: _col("insurance_plan_id"), 3: _col("insurance_plan_id"), 4: _col("insurance_company"),
            5: _components("", "", "", "", "", "USA"), 8: _col("insurance_group"), 12: _col("insurance_effective_date"),
            16: _name("last_name", "first_name"), 17: "18", 18: _col("dob"), 19: _address(), 36: _col("insurance_id"),
        },
        48,
    )


def segment_in2() -> Column:
    return segment("IN2", {2: _col("ssn"), 53: _col("insurance_expiration_date")}, 54)


def with_segments(events: DataFrame, sender: Mapping[str, str] | None = None) -> DataFrame:
    return events.withColumns(
        {
            "seg_msh": segment_msh(DEFAULT_SENDER | dict(sender or {})),
            "seg_evn": segment_evn(),
            "seg_pid": segment_pid(),
            "seg_nk1": segment_nk1(),
            "seg_pv1": segment_pv1(),
            "seg_pv2": segment_pv2(),
            "seg_dg1": segment_dg1(),
            "seg_al1": segment_al1(),
            "seg_gt1": segment_gt1(),
            "seg_in1": segment_in1(),
            "seg_in2": segment_in2(),
        }
    )


SEGMENTS = ["msh", "evn", "pid", "nk1", "pv1", "pv2", "dg1", "al1", "gt1", "in1", "in2"]


def assemble(events: DataFrame) -> DataFrame:
    """Message text: segments joined by carriage returns, missing ones left out."""
    return events.withColumn("hl7_message", F.concat_ws("\r", *[f"seg_{s}" for s in SEGMENTS]))


def messages(pool: DataFrame, sender: Mapping[str, str] | None = None, base: str = "2026-01-01 00:00:00") -> DataFrame:
    """Pool to message rows."""
    return assemble(with_segments(event_timing(explode_events(pool), base), sender))


MESSAGE_KEY = ("patient_id", "visit_id", "event_type", "event_datetime")
MESSAGE_UPDATES = ("event_order", "hl7_message", "batch_id", "created_at")


def message_table(rows: DataFrame, batch_id: str, created_at: Column | None = None, store: DataFrame | None = None) -> DataFrame:
    """Message table after merging one batch into ``store`` (None = first load).

    Two events of one batch that share a key (same patient, visit, code and time)
    are reduced to the later one before the merge.
    """
    staged = rows.select(
        generated_key(*MESSAGE_KEY).alias("message_pk"),
        *MESSAGE_KEY,
        "event_order",
        "hl7_message",
        F.lit(batch_id).alias("batch_id"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
    )
    staged = scd1(staged, ["message_pk"], "event_order", tiebreak=["hl7_message"])
    return merge_upsert(store, staged, ["message_pk"], MESSAGE_UPDATES)


def message_file_name() -> Column:
    return F.concat(F.concat_ws("_", *MESSAGE_KEY), F.lit(".hl7"))


def write_message_files(table: DataFrame, batch_id: str, folder: str) -> DataFrame:
    """One ``.hl7`` file per message of the batch."""
    from clinlake.sources.files import write_text_files

    batch = table.where(F.col("batch_id") == batch_id).withColumn("file_name", message_file_name())
    return write_text_files(batch, "file_name", "hl7_message", f"{folder.rstrip('/')}/hl7_files")


def write_sample_files(table: DataFrame, batch_id: str, folder: str, samples: int = 10) -> DataFrame:
    """The first few messages of the batch again as ``.txt`` samples."""
    from clinlake.sources.files import write_text_files

    batch = table.where(F.col("batch_id") == batch_id).withColumn("file_name", F.regexp_replace(message_file_name(), r"\.hl7$", ".txt"))
    picked = batch.orderBy("file_name").limit(samples)
    return write_text_files(picked, "file_name", "hl7_message", f"{folder.rstrip('/')}/txt_files")


def parse_adt(df: DataFrame, text: str = "hl7_message") -> DataFrame:
    """Message text to fields, by segment name and field number; absent parts give NULL."""
    lines = F.split(F.col(text), "\r")

    def fields(name: str) -> Column:
        return F.split(F.get(F.filter("_segments", lambda s: s.startswith(name + "|")), F.lit(0)), r"\|")

    def value(name: str, n: int) -> Column:
        return F.nullif(F.get(F.col(f"_{name}"), F.lit(n)), F.lit(""))

    def component(field: Column, n: int) -> Column:
        return F.nullif(F.get(F.split(field, r"\^"), F.lit(n)), F.lit(""))

    parts = df.withColumn("_segments", lines)
    for name in ("MSH", "EVN", "PID", "PV1", "DG1"):
        parts = parts.withColumn(f"_{name}", fields(name))
    code = F.regexp_extract(F.coalesce(value("MSH", 8), value("EVN", 1)), r"(A\d\d)$", 1)
    return parts.select(
        *df.columns,
        component(value("PID", 3), 0).alias("p_patient_id"),
        component(value("PID", 5), 0).alias("p_last_name"),
        component(value("PID", 5), 1).alias("p_first_name"),
        value("PID", 7).alias("p_birth_date"),
        value("PID", 8).alias("p_sex"),
        F.nullif(code, F.lit("")).alias("p_event_type"),
        value("EVN", 2).alias("p_event_datetime"),
        value("MSH", 9).alias("p_control_id"),
        value("PV1", 2).alias("p_patient_class"),
        value("PV1", 3).alias("p_location"),
        value("PV1", 52).alias("p_admit_datetime"),
        value("PV1", 53).alias("p_discharge_datetime"),
        component(value("DG1", 3), 0).alias("p_diagnosis_code"),
        F.size(F.filter("_segments", lambda s: s.startswith("AL1|"))).alias("p_allergies"),
    )


def generated_messages(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """Messages of ``n`` generated patients."""
    return messages(patient_pool(spark.range(n), "id", seed))
