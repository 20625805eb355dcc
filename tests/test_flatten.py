import json

import pytest
from pyspark.sql import functions as F

from bikeflow import schemas
from bikeflow.functions import documents
from bikeflow.operators import flatten
from bikeflow.plans import mappings
from bikeflow.sources import files


def bike(name, reach=(1.5, 2.5), charge=50):
    out = {"rideable_id": name, "battery_charge_percentage": charge, "displayed_number": "7",
           "docking_capability": 1, "is_lbs_internal_rideable": False, "make_and_model": "m"}
    if reach:
        out["range_estimate"] = {"conservative_range_miles": reach[0], "estimated_range_miles": reach[1]}
    return out


DOC = {
    "data": {"stations": [
        {"station_id": "s1", "ebikes": [bike("a"), bike("b", reach=None)]},
        {"station_id": "s2", "ebikes": []},
    ]},
    "last_updated": 100, "ttl": 60, "version": "1.1",
}


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(DOC))
    return tmp_path


def rows(df):
    return sorted((r.station_id, r.rideable_id or "", r.estimated_range_miles, str(r.last_updated)) for r in df.collect())


EXPECTED = [("s1", "a", 2.5, "100"), ("s1", "b", None, "100")]


def test_native_text_and_raw_paths_agree(spark, landing):
    native = files.read_json(spark, str(landing), schemas.document_fields(schemas.TELEMETRY_STATION))
    raw = files.read_json(spark, str(landing), schemas.RAW_DOCUMENT)
    parsed = documents.parse_document(F.col("value"), schemas.TELEMETRY_STATION)
    text = files.read_text(spark, str(landing)).select(parsed.alias("d")).select("d.*")
    for docs in (native, raw, text):
        assert rows(flatten.flatten_telemetry(docs)) == EXPECTED


def test_inferred_schema_agrees(spark, landing):
    assert rows(flatten.flatten_telemetry(files.query_path(spark, "json", str(landing)))) == EXPECTED


def test_outer_keeps_empty_stations(spark, landing):
    raw = files.read_json(spark, str(landing), schemas.RAW_DOCUMENT)
    assert rows(flatten.flatten_telemetry(raw, outer=True)) == EXPECTED + [("s2", "", None, "100")]


def test_malformed_document_is_skipped_or_raised(spark, tmp_path):
    (tmp_path / "a.json").write_text("{not json\n" + json.dumps(DOC) + "\n")
    lines = files.read_text(spark, str(tmp_path))
    lenient = documents.parse_document(F.col("value"), schemas.TELEMETRY_STATION)
    docs = lines.select(lenient.alias("d")).select("d.*")
    assert docs.count() == 2 and rows(flatten.flatten_telemetry(docs)) == EXPECTED
    strict = documents.parse_document(F.col("value"), schemas.TELEMETRY_STATION, strict=True)
    with pytest.raises(Exception):
        lines.select(strict.alias("d")).collect()


def test_pretty_printed_document(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(DOC, indent=2))
    raw = files.read_json(spark, str(tmp_path), schemas.RAW_DOCUMENT, multi_line=True)
    assert rows(flatten.flatten_telemetry(raw)) == EXPECTED
    whole = files.read_text(spark, str(tmp_path), whole_files=True)
    parsed = documents.parse_document(F.col("value"), schemas.TELEMETRY_STATION)
    assert rows(flatten.flatten_telemetry(whole.select(parsed.alias("d")).select("d.*"))) == EXPECTED


def test_sample_schema_parses_the_rest(spark, landing):
    sampled = files.sample_schema(spark, str(landing / "one.json"), "data.stations")
    assert sampled["stations"].dataType.elementType.fieldNames() == ["ebikes", "station_id"]


def test_schema_over_many_texts(spark):
    texts = spark.createDataFrame([('{"a": 1}',), ('{"b": "x"}',), ("broken",)], "value string")
    assert documents.infer_json_schema(texts, "value").first()[0] == "OBJECT<a: BIGINT, b: STRING>"


def test_route_totals(spark):
    text = json.dumps({"routes": [{"legs": [{"steps": [
        {"distance": 1234.0, "duration": 10.4}, {"distance": 100.0, "duration": 20.3}, {"duration": 1.0}]}]}]})
    df = spark.createDataFrame([(text,), ('{"routes": []}',)], "route string")
    steps = documents.first_leg_steps(F.from_json("route", schemas.ROUTE_DOCUMENT))
    got = df.select(documents.route_totals(steps).alias("t")).select("t.*").collect()
    assert tuple(got[0]) == (1.3, 32.0) and tuple(got[1]) == (None, None)


def test_landed_documents_take_a_fraction_of_their_text(spark, tmp_path):
    lines = spark.range(4000).selectExpr(
        "id AS l_orderkey", "id % 77 AS l_partkey", "id % 13 AS l_suppkey", "CAST(id % 7 AS int) AS l_linenumber",
        "CAST(id % 50 AS double) AS l_quantity", "id % 9 / 100 AS l_discount", "id % 8 / 100 AS l_tax",
        "if(id % 3 = 0, 'R', 'N') AS l_returnflag", "'O' AS l_linestatus", "timestamp_seconds(id) AS l_shipdate",
    )
    documents = mappings.nested_documents(lines).coalesce(1)
    text = documents.selectExpr("sum(length(value) + 1)").first()[0]
    mappings.text_files(documents, str(tmp_path / "landed"), per_file=1000)
    parts = list((tmp_path / "landed").glob("part-*"))
    assert len(parts) == 4
    assert sum(p.stat().st_size for p in parts) < text / 3
    assert sorted(r.value for r in files.read_text(spark, str(tmp_path / "landed")).collect()) == sorted(r.value for r in documents.collect())
    typed = schemas.document_fields(schemas.TELEMETRY_STATION)
    assert flatten.flatten_telemetry(files.read_json(spark, str(tmp_path / "landed"), typed)).count() == 8000
    assert flatten.flatten_telemetry(files.query_path(spark, "json", str(tmp_path / "landed"))).count() == 8000
