import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from fieldgauge import schemas
from fieldgauge.operators import inference_log as log

ROWS = [[21.5, 400.0, 700.0, 0.004], [22.5, 0.0, 500.0, 0.003]]


def payload(spark, *bodies):
    data = [
        (f"r{i}", 1700000000123 + i, 200, request, response, "meta")
        for i, (request, response) in enumerate(bodies)
    ]
    df = spark.createDataFrame(
        data,
        "request_id string, timestamp_ms long, status_code int, request string, response string, request_metadata string",
    )
    return df.withColumn("date", F.lit("2023-11-14").cast("date")).select(schemas.PAYLOAD_SCHEMA.fieldNames())


def inputs(*values):
    return json.dumps({"inputs": list(values)})


def answers(*values):
    return json.dumps({"predictions": list(values)})


def unpack(spark, *bodies, **options):
    clean, rejects = log.unpack_inference_log(payload(spark, *bodies), **options)
    flat = rows(clean.select("request_id", "pos", *schemas.MODEL_INPUTS, "Occupancy")) if "pos" in clean.columns else clean
    return flat, rows(rejects.select("request_id", "pos", "reason"))


def test_one_row_per_input_in_order(spark):
    clean, rejects = unpack(spark, (inputs(*ROWS), answers(1, 0)))
    assert clean == [("r0", 0, *ROWS[0], 1), ("r0", 1, *ROWS[1], 0)] and rejects == []


def test_output_columns_and_types(spark):
    clean, _ = log.unpack_inference_log(payload(spark, (inputs(ROWS[0]), answers(1))))
    types = dict(clean.dtypes)
    assert not {"request", "response", "request_metadata"} & set(types)
    assert types["Occupancy"] == "int" and types["model_id"] == "int" and types["CO2"] == "double"
    row = clean.select(F.unix_millis("timestamp_ms"), "model_id").first()
    assert tuple(row) == (1700000000123, 0)
    cut, _ = log.unpack_inference_log(payload(spark, (inputs(ROWS[0]), answers(1))), whole_seconds=True)
    assert cut.select(F.unix_millis("timestamp_ms")).first()[0] == 1700000000000


@pytest.mark.parametrize(
    "request_body, response_body, reason",
    [
        (None, answers(1), log.NULL_REQUEST),
        ("not json", answers(1), log.MALFORMED_REQUEST),
        ('{"dataframe_split": {"data": []}}', answers(1), log.UNSUPPORTED_REQUEST),
        ('{"inputs": [1, 2]}', answers(1), log.UNSUPPORTED_REQUEST),
        ('"text"', answers(1), log.UNSUPPORTED_REQUEST),
        ('{"inputs": []}', answers(1), log.EMPTY_REQUEST),
        (inputs(ROWS[0]), None, log.BAD_RESPONSE),
        (inputs(ROWS[0]), "oops", log.BAD_RESPONSE),
        (inputs(ROWS[0]), '{"predictions": null}', log.BAD_RESPONSE),
    ],
)
def test_unusable_request_is_rejected_with_its_reason(spark, request_body, response_body, reason):
    clean, rejects = unpack(spark, (request_body, response_body), (inputs(ROWS[1]), answers(0)))
    assert clean == [("r1", 0, *ROWS[1], 0)] and rejects == [("r0", None, reason)]


def test_wrong_arity_rejects_the_position_only(spark):
    body = (inputs(ROWS[0][:3], [*ROWS[1], 9.0], ROWS[0]), answers(1, 0, 1))
    clean, rejects = unpack(spark, body)
    assert clean == [("r0", 2, *ROWS[0], 1)]
    assert rejects == [("r0", 0, log.ARITY), ("r0", 1, log.ARITY)]
    clean, rejects = unpack(spark, body, strict_arity=False)
    assert clean == [("r0", 1, *ROWS[1], 0), ("r0", 2, *ROWS[0], 1)] and rejects == [("r0", 0, log.ARITY)]


def test_surplus_on_either_side(spark):
    clean, rejects = unpack(spark, (inputs(*ROWS), answers(1)), (inputs(ROWS[0]), answers(1, 0, 0)))
    assert clean == [("r0", 0, *ROWS[0], 1), ("r1", 0, *ROWS[0], 1)]
    assert rejects == [
        ("r0", 1, log.SURPLUS_INPUT), ("r1", 1, log.SURPLUS_PREDICTION), ("r1", 2, log.SURPLUS_PREDICTION)
    ]
    clean, rejects = unpack(spark, (inputs(ROWS[0]), answers()))
    assert clean == [] and rejects == [("r0", 0, log.SURPLUS_INPUT)]


def test_record_form_and_float_labels_are_accepted(spark):
    record = {"request_index": 0, **{f"input_{i}": v for i, v in enumerate(ROWS[0])}}
    clean, rejects = unpack(spark, (json.dumps([record]), answers(1.0)), (inputs(ROWS[1]), answers(0.0)))
    assert clean == [("r0", 0, *ROWS[0], 1), ("r1", 0, *ROWS[1], 0)] and rejects == []


def test_null_feature_is_kept(spark):
    clean, _ = unpack(spark, (inputs([None, 1.0, 2.0, 3.0]), answers(1)))
    assert clean == [("r0", 0, None, 1.0, 2.0, 3.0, 1)]


def test_equal_rows_stay_but_repeated_requests_do_not(spark):
    once = payload(spark, (inputs(ROWS[0], ROWS[0]), answers(1, 1)))
    again = once.withColumn("timestamp_ms", F.col("timestamp_ms") + 5000)
    clean, _ = log.unpack_inference_log(again.unionByName(once))
    assert clean.count() == 2
    assert clean.select(F.unix_millis("timestamp_ms")).distinct().collect() == [(1700000000123,)]
    merged, _ = log.unpack_inference_log(once.unionByName(once), dedup="row")
    assert merged.count() == 1
    with pytest.raises(ValueError):
        log.unpack_inference_log(once, dedup="none")


def brute_force(bodies):
    """Plain-Python unpacking, to check the JVM expressions against."""
    for i, (request, response) in enumerate(bodies):
        try:
            data = json.loads(request)["inputs"]
            labels = json.loads(response)["predictions"]
        except (ValueError, TypeError, KeyError):
            continue
        if not all(isinstance(x, list) for x in data):
            continue
        for pos, (x, y) in enumerate(zip(data, labels)):
            if len(x) == 4:
                yield (f"r{i}", pos, *map(float, x), int(y))


def test_matches_plain_python_on_mixed_bodies(spark):
    bodies = []
    for i in range(60):
        data = [[i + k, k * 0.5, 400 + i, 0.001 * k] for k in range(i % 5)]
        if i % 7 == 3 and data:
            data[0] = data[0][:2]
        request = {0: "{bad", 1: json.dumps({"other": data})}.get(i % 11, inputs(*data))
        bodies.append((request, answers(*[k % 2 for k in range((i * 3) % 6)])))
    clean, _ = unpack(spark, *bodies)
    assert clean == sorted(brute_force(bodies), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_plan_has_no_python_and_parses_once(spark):
    clean, _ = log.unpack_inference_log(payload(spark, (inputs(ROWS[0]), answers(1))))
    text = plan(clean)
    assert "Python" not in text and text.count("Generate posexplode") == 1
    assert text.count("from_json(StructField(inputs") == 1


def test_day_and_status_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "payload")
    payload(spark, (inputs(ROWS[0]), answers(1))).write.partitionBy("date").parquet(path)
    df = log.read_inference_log(spark.read.parquet(path), "2023-11-14")
    text = plan(df)
    assert "EqualTo(status_code,200)" in text and "PartitionFilters: [isnotnull(date" in text
    assert df.count() == 1
    assert log.read_inference_log(spark.read.parquet(path)).count() == 0


def test_captured_scores_unpack_to_the_same_rows(spark):
    scored = spark.createDataFrame(
        [(1, *ROWS[0], 1, 1700000000), (2, *ROWS[1], 0, 1700000060)],
        "Id int, Temperature double, Light double, CO2 double, HumidityRatio double, prediction int, s long",
    ).withColumn("at", F.timestamp_seconds("s"))
    captured = log.capture_scores(scored, schemas.MODEL_INPUTS, "prediction", F.col("Id"), "at")
    assert captured.columns == schemas.PAYLOAD_SCHEMA.fieldNames()
    clean, rejects = log.unpack_inference_log(captured)
    assert rows(clean.select("request_id", *schemas.MODEL_INPUTS, "Occupancy")) == [("1", *ROWS[0], 1), ("2", *ROWS[1], 0)]
    assert rejects.count() == 0


def _logged(spark, *rows):
    """(id, day, ms, status, request, response)"""
    df = spark.createDataFrame(rows, "request_id string, date string, timestamp_ms long, status_code int, request string, response string")
    return df.withColumn("date", F.to_date("date"))


def _inputs(n):
    return '{"inputs":[' + ",".join(f"[{i},1,1,1]" for i in range(n)) + "]}", '{"predictions":[' + ",".join("1" for _ in range(n)) + "]}"


def test_requests_without_an_id_are_all_kept(spark):
    logged = _logged(spark, (None, "2024-01-01", 1, 200, *_inputs(2)), (None, "2024-01-01", 1, 200, *_inputs(3)), (None, "2024-01-01", 1, 200, *_inputs(3)))
    clean, rejects = log.unpack_inference_log(logged)
    assert clean.count() == 5 and rejects.count() == 0 and clean.select("request_id").distinct().count() == 2


def test_a_retry_with_another_body_is_not_mixed_in(spark):
    logged = _logged(spark, ("a", "2024-01-01", 5, 200, *_inputs(1)), ("a", "2024-01-01", 9, 200, *_inputs(3)))
    assert [tuple(r) for r in log.unpack_inference_log(logged)[0].select("request_id", "pos").collect()] == [("a", 0)]


@pytest.mark.parametrize(("prediction", "faults"), [("0.7", ["bad_prediction"]), ("null", ["bad_prediction"]), ("1.0", []), ("1e12", ["bad_prediction"])])
def test_only_whole_numbers_are_predictions(spark, prediction, faults):
    logged = _logged(spark, ("a", "2024-01-01", 5, 200, _inputs(1)[0], '{"predictions":[' + prediction + "]}"))
    clean, rejects = log.unpack_inference_log(logged)
    assert [r["reason"] for r in rejects.collect()] == faults and clean.count() == 1 - len(faults)


def test_leading_white_space_of_a_body(spark):
    body, answer = _inputs(1)
    assert log.unpack_inference_log(_logged(spark, ("a", "2024-01-01", 5, 200, "\r\n\t " + body, answer)))[0].count() == 1


def test_requests_without_an_id_are_told_apart(spark):
    from fieldgauge.operators.inference_log import one_row_each

    bodies = [("x", None), (None, "x"), ("a|b", "c"), ("a", "b|c"), ("", None), (None, None), ("a", "b|c")]
    data = [(None, 5, request, response) for request, response in bodies] + [(None, None, "x", None)]
    logged = spark.createDataFrame(data, "request_id string, timestamp_ms long, request string, response string")
    kept = one_row_each(logged).collect()
    assert len(kept) == 7 and len({r["request_id"] for r in kept}) == 7
    named = spark.createDataFrame([("r", 5, None, "x"), ("r", 5, "x", None)], logged.schema)
    assert one_row_each(named).collect() == one_row_each(named.orderBy(F.col("request").asc_nulls_last())).collect()
