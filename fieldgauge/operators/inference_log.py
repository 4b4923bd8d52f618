"""Logged model requests to flat rows of features and prediction."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge import schemas
from fieldgauge.functions.evaluation_order import computed_once
from fieldgauge.functions.payload import inputs_body, is_json, is_label, parse_inputs, parse_predictions, predictions_body
from fieldgauge.functions.scalars import epoch_millis_to_timestamp

SUCCESS = 200
REQUEST_KEY = "request_id"
POSITION = "pos"
BODY_COLUMNS = ["request", "response", "request_metadata"]
NO_ID = "content-"  # leads the id given to a request that was logged without one

# Reasons a request, or one position of it, is rejected.
NULL_REQUEST = "null_request"
MALFORMED_REQUEST = "malformed_request"
UNSUPPORTED_REQUEST = "unsupported_request"
EMPTY_REQUEST = "empty_request"
BAD_RESPONSE = "bad_response"
BAD_PREDICTION = "bad_prediction"
ARITY = "arity"
SURPLUS_INPUT = "surplus_input"
SURPLUS_PREDICTION = "surplus_prediction"


def read_inference_log(payload: DataFrame, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Successful requests of one day, by default the last complete one.

    Both predicates reach the scan; on a table partitioned by ``date`` the second one picks
    the partition.
    """
    if as_of is None:
        day = F.date_sub(F.current_date(), 1)
    else:
        day = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    return successful(payload).where(F.col("date") == day)


def successful(payload: DataFrame) -> DataFrame:
    return payload.where(F.col("status_code") == SUCCESS)


def one_row_each(payload: DataFrame, request_key: str = REQUEST_KEY) -> DataFrame:
    """One logged row per request id: the earliest, whole, so that no two bodies are mixed.

    A request without an id gets one made of its time and bodies (as JSON, which tells NULL from
    empty and one body from the other), so that it is kept, and a repeat of it is known as one. Rows are limited before the shuffle, so an id that is logged
    over and over does not gather in one task; equal times are ordered by a hash of the bodies, so that
    no second copy of them moves.
    """
    bodies = F.to_json(F.struct("timestamp_ms", "request", "response"), {"ignoreNullFields": "false"})
    content = F.sha2(bodies, 256)
    named = payload.withColumn(request_key, F.coalesce(F.col(request_key), F.concat(F.lit(NO_ID), content)))
    earliest = Window.partitionBy(request_key).orderBy(F.col("timestamp_ms").asc_nulls_last(), F.xxhash64(bodies), "request", "response")
    return named.withColumn("__n", F.row_number().over(earliest)).where("__n = 1").drop("__n")


def _parsed(payload: DataFrame, n_inputs: int) -> DataFrame:
    """Bodies parsed to arrays, with the reason why a request cannot be used."""
    arrays = computed_once(
        payload,
        {
            "__inputs": parse_inputs(F.col("request"), n_inputs),
            "__predictions": parse_predictions(F.col("response")),
        },
    )
    reason = (
        F.when(F.col("request").isNull(), NULL_REQUEST)
        .when(F.col("__inputs").isNull() & ~is_json(F.col("request")), MALFORMED_REQUEST)
        .when(F.col("__inputs").isNull(), UNSUPPORTED_REQUEST)
        .when(F.size("__inputs") == 0, EMPTY_REQUEST)
        .when(F.col("__predictions").isNull(), BAD_RESPONSE)
    )
    return arrays.withColumn("__reason", reason)


def _positions(parsed: DataFrame, n_inputs: int, strict_arity: bool) -> DataFrame:
    """One row per position, the i-th input with the i-th prediction, and its fault if any.

    A single explode of the zipped arrays; it also yields the positions that only the longer
    of the two has. Lengths decide what is missing, as an array may hold a NULL. A request
    that cannot be used stays one row without a position.
    """
    pair = F.struct(
        F.lit(None).cast("array<double>").alias("x"), F.lit(None).cast("double").alias("y")
    )
    zipped = F.arrays_zip(F.col("__inputs").alias("x"), F.col("__predictions").alias("y"))
    usable = F.col("__reason").isNull()
    kept = [c for c in parsed.columns if c not in ("__inputs", "__predictions", *BODY_COLUMNS)]
    rows = parsed.select(
        *kept,
        F.size("__inputs").alias("__n_inputs"),
        F.size("__predictions").alias("__n_predictions"),
        F.posexplode(F.when(usable, zipped).otherwise(F.array(pair))).alias("__at", "__pair"),
    )
    width = F.coalesce(F.size("__pair.x"), F.lit(-1))
    wrong = (width != n_inputs) if strict_arity else (width < n_inputs)
    fault = (
        F.when(~usable, F.col("__reason"))
        .when(F.col("__at") >= F.col("__n_predictions"), SURPLUS_INPUT)
        .when(F.col("__at") >= F.col("__n_inputs"), SURPLUS_PREDICTION)
        .when(wrong, ARITY)
        .when(~is_label(F.col("__pair.y")), BAD_PREDICTION)
    )
    return rows.withColumns({POSITION: F.when(usable, F.col("__at")), "__fault": fault})


def unpack_positions(
    payload: DataFrame,
    n_inputs: int,
    request_key: str = REQUEST_KEY,
    dedup: str = "request",
    strict_arity: bool = True,
) -> DataFrame:
    """Every position of every request with its fault, if any: what both results are cut from.

    A job that needs the clean rows and the rejects stores this once and splits the stored table,
    so that the bodies are parsed once.
    """
    if dedup not in ("request", "row"):
        raise ValueError("dedup is 'request' or 'row'")
    chosen = one_row_each(payload, request_key) if dedup == "request" and request_key in payload.columns else payload
    return _positions(_parsed(chosen, n_inputs), n_inputs, strict_arity)


def split_positions(
    positions: DataFrame,
    features: list[str] | None = None,
    prediction: str = schemas.LABEL,
    request_key: str = REQUEST_KEY,
    dedup: str = "request",
    whole_seconds: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects) from the table of :func:`unpack_positions`."""
    features = features or schemas.MODEL_INPUTS
    own = ("timestamp_ms", POSITION, "__fault", "__reason", "__n_inputs", "__n_predictions", "__at", "__pair")
    through = [c for c in positions.columns if c not in own]
    clean = positions.where(F.col("__fault").isNull()).select(
        *through,
        POSITION,
        epoch_millis_to_timestamp(F.col("timestamp_ms"), whole_seconds).alias("timestamp_ms"),
        *[F.get("__pair.x", F.lit(i)).alias(name) for i, name in enumerate(features)],
        F.col("__pair.y").cast("int").alias(prediction),
        F.lit(0).cast("int").alias("model_id"),
    )
    if dedup == "row":
        clean = clean.drop(POSITION).dropDuplicates()
    identity = [c for c in (request_key, "date") if c in positions.columns]
    rejects = positions.where(F.col("__fault").isNotNull()).select(*identity, POSITION, F.col("__fault").alias("reason"))
    return clean, rejects if dedup == "request" else rejects.dropDuplicates()


def unpack_inference_log(
    payload: DataFrame,
    features: list[str] | None = None,
    prediction: str = schemas.LABEL,
    request_key: str = REQUEST_KEY,
    dedup: str = "request",
    strict_arity: bool = True,
    whole_seconds: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects): rows of features and prediction, and what could not be unpacked.

    ``features`` names the inputs in model order. ``dedup="request"`` keeps the earliest logged row
    of each request id, with all its positions; ``"row"`` removes every fully equal row. A request
    without an id is kept under an id made of its content. A prediction must be a whole number.
    With ``strict_arity=False`` values beyond the known inputs are ignored.
    ``whole_seconds`` cuts the request time to seconds.
    """
    features = features or schemas.MODEL_INPUTS
    positions = unpack_positions(payload, len(features), request_key, dedup, strict_arity)
    return split_positions(positions, features, prediction, request_key, dedup, whole_seconds)


def capture_scores(
    scored: DataFrame,
    features: list[str],
    prediction: str,
    request_key: Column,
    moment: str,
) -> DataFrame:
    """Payload-shaped log of scored rows, one request per row; ``moment`` is a timestamp."""
    at = F.col(moment)
    return scored.select(
        request_key.cast("string").alias(REQUEST_KEY),
        F.to_date(at).alias("date"),
        F.unix_millis(at.cast("timestamp")).alias("timestamp_ms"),
        F.lit(SUCCESS).alias("status_code"),
        inputs_body(features).alias("request"),
        predictions_body(prediction).alias("response"),
        F.lit(None).cast("string").alias("request_metadata"),
    )
