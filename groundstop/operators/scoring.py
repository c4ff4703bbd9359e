"""Scoring requests and responses as columns (set-at-a-time, no per-row calls).

A request is the text ``"carrier,origin,dest,week,hour"`` (or its JSON
wrapper ``{"feature": ...}``); a response is ``(prediction, proba)`` with
``proba`` the winning class's probability as text rounded to 2 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, ROW_KEY

REQUEST_FIELDS = list(CATEGORICAL_FEATURES) + list(NUMERIC_FEATURES)  # carrier, origin, dest, week, hour


def request_frame(sim: DataFrame, drop: tuple[str, ...] = ("fl_id", "cancel")) -> DataFrame:
    """Drop the id and the label, add the comma-joined feature text.

    A null value leaves its place empty, so the other fields keep theirs.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in REQUEST_FIELDS]
    return sim.drop(*drop).withColumn("feature", F.concat_ws(",", *fields))


def parse_requests(df: DataFrame, feature: str = "feature", keep: list[str] | None = None) -> DataFrame:
    """Split the feature text and type its parts (week and hour as int).

    A missing, empty or unreadable part is null; so is every part of a text
    with more or fewer parts.  No request fails the job: ``request_valid``
    tells which can be scored.
    """
    keep = [ROW_KEY] if keep is None and ROW_KEY in df.columns else (keep or [])
    # Exploding a one-element array computes the parts once per row; a projected column would be computed at every use.
    split = df.select(*keep, F.explode(F.array(F.split(F.col(feature), ",", -1))).alias("_parts"))
    whole = F.size("_parts") == len(REQUEST_FIELDS)
    typed = []
    for i, name in enumerate(REQUEST_FIELDS):
        part = F.when(whole, F.nullif(F.trim(F.get("_parts", F.lit(i))), F.lit("")))
        typed.append((part.try_cast("int") if name in NUMERIC_FEATURES else part).alias(name))
    return split.select(*keep, *typed)


def parse_records(df: DataFrame, record_json: str = "record_json", keep: list[str] | None = None) -> DataFrame:
    """Rows of batch records ``{"data": {"rows": [[carrier, origin, dest, week, hour], ...]}}``.

    One output row per record row, with ``row_no`` its place in the record.
    A record without rows, a null one and one that is not such JSON come back
    as one row with a null ``row_no``, so that no record is lost.
    """
    rows = F.from_json(F.col(record_json), "data struct<rows array<array<string>>>")["data"]["rows"]
    flat = df.select(*(keep or []), F.posexplode_outer(rows).alias("row_no", "_row"))
    text = F.concat_ws(",", F.transform("_row", lambda x: F.coalesce(x, F.lit(""))))
    return parse_requests(flat.withColumn("_feature", text), "_feature", keep=[*(keep or []), "row_no"])


def reply_records(scored: DataFrame, key: str, order: str = "row_no") -> DataFrame:
    """One reply per record: ``{"version": "1.0", "data": {"colnames": ..., "coltypes": ..., "rows": [[prediction, "proba"], ...]}}``.

    Rows are in the record's order; a row that could not be scored is
    ``[null,null]``, a record without rows has none.
    """
    proba = F.when(F.col("proba").isNotNull(), F.concat(F.lit('"'), F.col("proba"), F.lit('"')))
    cells = F.concat(F.lit("["), F.coalesce(F.col("prediction").cast("string"), F.lit("null")), F.lit(","), F.coalesce(proba, F.lit("null")), F.lit("]"))
    row = F.when(F.col(order).isNotNull(), F.struct(F.col(order).alias("at"), cells.alias("cells")))
    rows = F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda r: r["cells"]), ",")
    head = '{"version":"1.0","data":{"colnames":["prediction","proba"],"coltypes":["INT","STRING"],"rows":['
    return scored.groupBy(key).agg(F.concat(F.lit(head), rows, F.lit("]}}")).alias("reply_json"))


# ISO weeks are 1-53 and departure hours 0-24.
WEEK_RANGE = (1, 53)
HOUR_RANGE = (0, 24)


def request_valid(week: str = "week", hour: str = "hour"):
    """True when every part is there and week and hour are in range (a week list of 0-51 would not be)."""
    in_range = F.col(week).between(*WEEK_RANGE) & F.col(hour).between(*HOUR_RANGE)
    named = F.lit(True)
    for c in CATEGORICAL_FEATURES:
        named = named & F.col(c).isNotNull()
    return F.coalesce(in_range & named, F.lit(False))


def to_request_json(feature: str = "feature"):
    return F.to_json(F.struct(F.col(feature).alias("feature")))


def from_request_json(json_col: str = "request_json"):
    return F.from_json(F.col(json_col), "feature string").getField("feature")


def threshold(df: DataFrame, p: str = "p_cancel", at: float = 0.5, out: str = "response_label") -> DataFrame:
    """Boolean label from class 1's probability."""
    return df.withColumn(out, F.col(p) >= F.lit(at))


def response_columns(p: str = "p_cancel", prediction: str = "prediction") -> list:
    """``prediction`` (int) and ``proba``: the winning probability, rounded, as text."""
    return [
        F.col(prediction).cast("int").alias("prediction"),
        F.round(F.greatest(F.col(p), F.lit(1.0) - F.col(p)), 2).cast("string").alias("proba"),
    ]
