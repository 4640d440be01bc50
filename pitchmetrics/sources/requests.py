"""Request documents, one JSON object per line, read as a table of requests.

req_type 1: forecast ({"date", "team1": {"name", slot: player name, ...}, "team2"}),
req_type 2: player profile ({"name"}), no req_type: match details ({"label"}).

Defined cases: a line that is not one JSON object of these fields is 'rejected' and answered
'Invalid'; blank lines are no requests; a date that is none is NULL, and a forecast without
a date is answered 'Invalid'.  A request without ``request_id`` has a stable id from its
text, so equal lines are one request with one answer; of different lines with one id, the
one that is smallest as text counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions.columns import parse_date
from ..operators.requests import route_requests

CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = StructType(schemas.REQUEST_RECORD.fields + [StructField(CORRUPT, StringType())])


def requests_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    r = F.from_json(F.col("value"), _PARSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = (lines.select(F.col(value_col).alias("value")).filter(F.trim("value") != "").withColumn("r", r)
              .withColumn("broken", F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()))
    routed = route_requests(parsed.select(
        "value", "broken", F.coalesce(F.when(~F.col("broken"), F.col("r.request_id")), F.xxhash64("value")).alias("request_id"),
        "r.req_type", "r.name", "r.label", parse_date("r.date").alias("date"), "r.team1", "r.team2"))
    rest = ["request_kind", "name", "label", "date", "team1", "team2"]
    kind = F.when(F.col("broken"), "rejected").otherwise(F.col("request_kind"))
    return (routed.withColumn("request_kind", kind)
            .groupBy("request_id").agg(F.min_by(F.struct(*rest), F.col("value")).alias("q")).select("request_id", "q.*"))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return requests_from_lines(spark.read.text(path))
