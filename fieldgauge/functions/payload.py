"""Expressions over logged request and response bodies. JSON is parsed on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANKS = " \t\r\n"  # white space of JSON


def parse_inputs(body: Column, n_inputs: int) -> Column:
    """Array of input rows (arrays of double), or NULL if the body has neither known form.

    The forms are ``{"inputs": [[..], ..]}`` and a list of records ``{"input_0": .., ..}``.
    The first character picks the parser, so a body is parsed once.
    """
    rows = F.from_json(body, "inputs array<array<double>>")["inputs"]
    names = [f"input_{i}" for i in range(n_inputs)]
    records = F.from_json(body, "array<struct<{}>>".format(",".join(f"{n}:double" for n in names)))
    record_rows = F.transform(records, lambda r: F.array(*[r[n] for n in names]))
    first = F.substring(F.ltrim(body, F.lit(BLANKS)), 1, 1)
    return F.when(first == "[", record_rows).when(first == "{", rows)


def parse_predictions(body: Column) -> Column:
    """Predicted labels as an array of numbers; 1 and 1.0 are the same label."""
    return F.from_json(body, "predictions array<double>")["predictions"]


def is_label(prediction: Column) -> Column:
    """A whole number that fits an int; 0.7 and NULL are no labels."""
    return F.coalesce((prediction == F.floor(prediction)) & (F.abs(prediction) < 2**31), F.lit(False))


def is_json(body: Column) -> Column:
    return F.try_parse_json(body).isNotNull()


def inputs_body(features: list[str]) -> Column:
    """Request body of one row: ``{"inputs": [[..]]}`` in model-input order."""
    return F.to_json(F.struct(F.array(F.array(*[F.col(c).cast("double") for c in features])).alias("inputs")))


def predictions_body(prediction: str) -> Column:
    return F.to_json(F.struct(F.array(F.col(prediction).cast("int")).alias("predictions")))
