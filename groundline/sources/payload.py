"""Request and response JSON of the question endpoint, as columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT_SCHEMA = "dataframe_split STRUCT<columns: ARRAY<STRING>, data: ARRAY<ARRAY<STRING>>>"


def payload_values(payload: Column, name: str = "query") -> Column:
    """All values of the field `name` in one request, as an array of strings.

    Understands the split form `{"dataframe_split": {"columns": [..], "data": [[..]]}}` and the
    `inputs` form, whose value is lists by name, a list of records, or one record. Anything else
    gives an empty array.
    """
    split = F.from_json(payload, SPLIT_SCHEMA)["dataframe_split"]
    position = F.array_position(split["columns"], F.lit(name)).cast("int")
    from_split = F.when(position > 0, F.transform(split["data"], lambda row: F.get(row, position - 1)))

    inputs = F.get_json_object(payload, "$.inputs")
    from_lists = F.from_json(F.get_json_object(inputs, f"$.{name}"), "ARRAY<STRING>")
    records = F.from_json(inputs, "ARRAY<MAP<STRING, STRING>>")
    from_records = F.filter(F.transform(records, lambda r: r[name]), lambda v: v.isNotNull())
    one_record = F.array_compact(F.array(F.get_json_object(inputs, f"$.{name}")))

    return F.coalesce(
        from_split,
        F.when(inputs.startswith("["), from_records),
        F.when(inputs.startswith("{"), F.coalesce(from_lists, one_record)),
        F.array().cast("array<string>"),
    )


def decode_payload(requests: DataFrame, payload_col: str = "payload", name: str = "query") -> DataFrame:
    """One row per value: the other columns, `pos` within the request, and the value as `name`."""
    others = [c for c in requests.columns if c != payload_col]
    return requests.select(*others, F.posexplode(payload_values(F.col(payload_col), name)).alias("pos", name))


def encode_split(query: Column) -> Column:
    """A request in split form for one question."""
    body = F.struct(F.array(F.lit("query")).alias("columns"), F.array(F.array(query)).alias("data"))
    return F.to_json(F.struct(body.alias("dataframe_split")))


def encode_inputs(query: Column) -> Column:
    """A request in named-list form for one question."""
    return F.to_json(F.struct(F.struct(F.array(query).alias("query")).alias("inputs")))


def data_array(responses: DataFrame, response_col: str = "response") -> DataFrame:
    """Unwrap `result.data_array` of search responses, one row per hit row.

    A response without a result keeps one row whose `pos` and `hit` are NULL.
    """
    parsed = F.from_json(F.col(response_col), "result STRUCT<data_array: ARRAY<ARRAY<STRING>>>")
    rows = F.coalesce(parsed["result"]["data_array"], F.array().cast("array<array<string>>"))
    others = [c for c in responses.columns if c != response_col]
    return responses.select(*others, F.posexplode_outer(rows).alias("pos", "hit"))


def first_prediction(response: Column) -> Column:
    """`predictions[0]` of a response, NULL if there is none."""
    return F.get(F.from_json(response, "predictions ARRAY<STRING>")["predictions"], 0)
