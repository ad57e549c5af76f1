"""The registry preset, from a landed extract to metrics and text."""

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import explore, history as h, quality
from tidemark.operators.shaping import categorize, describe_row
from tidemark.plans import jobs
from tidemark.presets import vehicle_registry as vr
from tidemark.sinks.history_store import HistoryStore
from tidemark.sources.files import scan_parquet


def test_contracts():
    tables = {t.name: t for t in vr.contracts()}
    assert {n: len(t.columns) for n, t in tables.items()} == {
        "odometer_reading_judgment_explanation": 2,
        "registered_vehicles": 98,
        "registered_vehicles_axles": 16,
        "registered_vehicles_fuel": 37,
        "registered_vehicles_body": 4,
        "registered_vehicles_body_specification": 5,
        "registered_vehicles_class": 5,
        "registered_vehicles_subcategory": 4,
        "registered_vehicles_special_features": 6,
        "registered_vehicles_crawler_tracks": 7,
    }
    assert [n for n, t in tables.items() if t.tracked] == ["registered_vehicles"]
    main = tables["registered_vehicles"]
    assert main.primary_keys() == ["license_plate"]
    parent = main.foreign_keys()["odometer_judgment_explanation_code"]
    assert parent.table == "odometer_reading_judgment_explanation" and parent.column in {
        c.output_col for c in tables[parent.table].columns
    }
    assert all(fk.table in tables for t in tables.values() for fk in t.foreign_keys().values())


def test_checks_and_gold_fit_the_contracts():
    main = {c.output_col for c in vr.contract("registered_vehicles").columns}
    spec = vr.gold_spec()
    assert (len(spec.columns), len(spec.dedup_columns)) == (49, 34)
    assert {*spec.columns, *spec.dedup_columns, *spec.dedup_by, *spec.equals} <= main
    assert len(spec.view.dimensions) == 8 and len(spec.view.measures) == 6
    found = vr.checks("registered_vehicles")
    assert [c.criticality for c in found] == ["error"] * 5 + ["warn"] * 4
    assert [c.name for c in vr.checks("registered_vehicles_fuel")] == ["fk_license_plate_not_null"]
    assert len(vr.checks("odometer_reading_judgment_explanation")) == 2


def vehicles(spark, *changes):
    """Raw extract rows: every header present, given values filled in."""
    headers = [c.input_col for c in vr.contract("registered_vehicles").columns]
    common = {
        "Voertuigsoort": "Personenauto", "Export indicator": "Nee", "Taxi indicator": "Nee", "WAM verzekerd": "Ja",
        "Merk": "AUDI", "Handelsbenaming": "A4", "Datum eerste toelating": "20200115", "Cilinderinhoud": "1984",
        "Code toelichting tellerstandoordeel": "07",
    }
    data = [tuple({**common, **c}.get(h_) for h_ in headers) for c in changes]
    return spark.createDataFrame(data, ", ".join(f"`{h_}` string" for h_ in headers))


def test_registry_runs_through_all_layers(spark, tmp_path):
    contract, layers = vr.contract("registered_vehicles"), jobs.Layers(str(tmp_path), "registered_vehicles")
    landing = str(tmp_path / "landing")
    dumps = {
        "2024-01-01T9-5": [
            {"Kenteken": "AB12CD"},
            {"Kenteken": "EF34GH", "Cilinderinhoud": "999"},
            {"Kenteken": "TAXI01", "Taxi indicator": "Ja"},
            {"Kenteken": "TOOLONG1"},
            {"Kenteken": "NOMAKE", "Merk": None},
        ],
        "2024-02-01T10-0": [{"Kenteken": "AB12CD", "Export indicator": "Ja"}, {"Kenteken": "EF34GH", "Cilinderinhoud": "999"}],
    }
    runs = []
    for folder, changes in dumps.items():
        vehicles(spark, *changes).write.option("header", True).csv(f"{landing}/{folder}/registered_vehicles.csv")
        runs.append(
            jobs.job_all_layers(
                spark, contract, vr.checks(contract.name), vr.gold_spec(), landing, layers, folder[:10], buckets=4
            )
        )
        if len(runs) == 1:
            assert rows(scan_parquet(spark, layers.gold), "license_plate") == [("AB12CD",), ("EF34GH",)]
            assert rows(scan_parquet(spark, layers.gold_dedup), "make", "engine_displacement") == [("AUDI", 1984)]
            totals = vr.metric_view().query(scan_parquet(spark, layers.gold), ["make"]).first()
            assert (totals["vehicle_count"], totals["unique_models"], totals["avg_engine_displacement"]) == (2, 1, 1491.5)
    assert [(r.n_total, r.n_quarantined) for r in runs] == [(5, 2), (2, 0)]
    history = HistoryStore(spark, layers.silver).read_all()
    assert rows(history, "license_plate", h.OPERATION, h.VERSION) == [
        ("AB12CD", "INSERT", 1),
        ("AB12CD", "UPDATE", 2),
        ("EF34GH", "INSERT", 1),
        ("TAXI01", "DELETE", 1),
    ]
    assert rows(scan_parquet(spark, layers.gold), "license_plate") == [("EF34GH",)]
    codes = spark.createDataFrame([("00",)], "odometer_judgment_explanation_code string")
    report = jobs.fk_report(h.current_records(history), contract, {"odometer_reading_judgment_explanation": codes})
    assert report["odometer_judgment_explanation_code"].count() == 2
    assert h.invariant_violations(history, contract.primary_keys()).isEmpty()


def test_display(spark):
    data = [("AB12CD", "AUDI", "A4", "Personenauto", "GRIJS", 1984, 1405, 5, "20200115", 120)]
    cars = spark.createDataFrame(
        data,
        "kenteken string, merk string, handelsbenaming string, voertuigsoort string, eerste_kleur string, "
        "cilinderinhoud int, massa_ledig_voertuig int, aantal_zitplaatsen int, datum_eerste_toelating string, extra int",
    )
    text = describe_row(cars, vr.description_parts()).first()["description"]
    assert text == "Type: Personenauto • Color: GRIJS • Engine: 2.0L • Weight: 1405kg • Seats: 5 • Year: 2020"
    details = {r["label"]: (r["category"], r["value"]) for r in categorize(cars, "kenteken", vr.display_categories(), vr.display_kinds()).collect()}
    assert details["Datum Eerste Toelating"] == ("Historic", "January 15, 2020")
    assert details["Massa Ledig Voertuig"] == ("Weights/Dimensions", "1405kg") and details["Extra"] == ("Other", "120")
    state = {"brands": ["AUDI"], "colors": ["GRIJS", "ROOD"], "seats": [5, 7], "year_range": [2019, 2021]}
    assert explore.facet_filter(cars, vr.search_filter(state)).count() == 1
    assert explore.facet_filter(cars, vr.search_filter({**state, "engine_range": [500, 1000]})).count() == 0


def test_wide_contract_splits_in_one_pass(spark):
    raw = vehicles(spark, {"Kenteken": "AB12CD"}, {"Kenteken": None})
    from tidemark.operators.typing import apply_contract

    valid, rejected = quality.split(apply_contract(raw, vr.contract("registered_vehicles")), vr.checks("registered_vehicles"))
    assert valid.count() == 1 and rejected.select(F.size("_errors")).first()[0] == 1
