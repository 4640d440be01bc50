"""What a plan reads and computes once: events' tags and properties, and forecast requests."""

from conftest import SF001
from pitchmetrics.functions.columns import tag_mask
from pitchmetrics.operators import metrics
from pitchmetrics.operators.events import TAG_BITS, player_events
from pitchmetrics.plans import catalog
from pitchmetrics.sources import testdata


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tag_mask_has_no_interpreted_lambda(spark):
    ev = spark.createDataFrame([(1, [(101,), (1801,), (7,)]), (2, []), (3, None), (4, [(None,), (102,)]), (5, [(302,), (302,)]), (6, [None, (101,)])],
                               "i int, tags array<struct<id:int>>").repartition(1)
    got = {r.i: r.m for r in ev.select("i", tag_mask(TAG_BITS).alias("m")).collect()}
    assert got == {1: TAG_BITS[101] | TAG_BITS[1801], 2: 0, 3: 0, 4: TAG_BITS[102], 5: TAG_BITS[302], 6: TAG_BITS[101]}
    assert "lambda" not in _optimized(ev.select("i", tag_mask(TAG_BITS).alias("m")))


def test_player_events_drops_system_empty_and_null_ids(spark):
    ev = spark.createDataFrame([("0",), ("",), (None,), ("7",)], "player_id string")
    assert [r.player_id for r in player_events(ev).collect()] == ["7"]


def test_event_properties_are_parsed_once(spark):
    plan = _optimized(metrics.match_metrics(testdata.events(spark, SF001)))
    assert plan.count("get_json_object") == 1


def test_forecasts_read_stored_requests(spark):
    for name in ("match_forecast", "lineup_roles"):
        files = catalog.QUERIES[name](spark, SF001).inputFiles()
        assert files and not [f for f in files if "events.parquet" in f], name
