"""Structured Streaming ingestion of the record stream (T1, T2, T4-T7).

``readStream`` of text lines (a directory of files; a socket or Kafka topics work the same)
-> ``foreachBatch``.  Matches are *open* until they are *frozen*.  Each micro-batch ``b``:

1. parses its lines once into the archive, one write for all kinds of lines;
2. merges the open matches' records (the largest ``arrival`` counts, of equal ones the later
   batch) and per-(match, player) metric *counts* (sums, so counts of a match spread over
   batches add up exactly) with those of the batch, and writes both as a new generation;
3. closes every open match anew: facts (participants ⟕ metrics from the counts) and
   ratings, folded from each player's rating at the last freeze.  So a record that comes
   again, late events or matches out of order correct what was written before;
4. freezes matches whose date is ``horizon_days`` behind the newest match date, a few days'
   worth at a time: their facts and ratings stay as they are, and what later batches need of
   them is added up in small tables (a player's last rating and career sums, a pair's
   chemistry steps, a player's running pass sums);
5. publishes a commit (:mod:`.store`), which makes all of this visible at once.

How a match ends: with its record, when it is frozen.  Events whose record has not come
``horizon_days`` after they were first met (by the newest match date of that batch, so
that a replay decides the same), and events that come for a match that has been frozen, go to
``orphans`` with their counts; a record dated in the frozen part of the season goes to
``late_records``.  Nothing is lost: the archive holds all lines, and
``season_from_store(..., include_late=True)`` computes a season from it in full.  With
``horizon_days=None`` matches stay open for good, which suits a bounded season.

A batch reads its own lines, the open matches and tables of a row per player that is
still to be rated; it neither reads nor writes in proportion to the history.  A batch that the
checkpoint replays after a failure overwrites its own folders, one that was committed is
skipped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import chemistry as _chem
from ..operators import facts as _facts
from ..operators import metrics as _metrics
from ..operators import ratings as _ratings
from ..operators import squads as _squads
from ..sources.records import event_columns, match_columns, parse_records
from .store import COMPACT_PARTS, Commit, Store

#: days a match stays open behind the newest match date
HORIZON_DAYS = 14
#: days that are frozen at a time, at least
FREEZE_DAYS = 7


def record_stream(spark: SparkSession, path: str | None = None, *, max_files_per_trigger: int | None = None,
                  socket: tuple[str, int] | None = None, kafka: dict[str, str] | None = None) -> DataFrame:
    """Streaming DataFrame of record lines (column ``value``): a directory of text
    files, a socket when ``socket=(host, port)`` is given, or Kafka topics when ``kafka``
    gives the source's options (``kafka.bootstrap.servers``, ``subscribe``, ...)."""
    if kafka is not None:
        return spark.readStream.format("kafka").options(**kafka).load().select(F.col("value").cast("string").alias("value"))
    if socket is not None:
        host, port = socket
        return spark.readStream.format("socket").option("host", host).option("port", port).load()
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


# --- one micro-batch ------------------------------------------------------------------------

def _archive(store: Store, batch: DataFrame, batch_id: int) -> None:
    """All lines of the batch by kind; a match record without a date is of kind 'undated'."""
    parsed = parse_records(batch).select("value", "kind", F.struct(*event_columns()).alias("event"), F.struct(*match_columns()).alias("record"))
    kind = F.when((F.col("kind") == "match") & F.col("record.match_date").isNull(), "undated").otherwise(F.col("kind"))
    rows = parsed.withColumn("kind", kind)
    kept = rows.select(F.when(~F.col("kind").isin("event", "match"), F.col("value")).alias("value"),
                       F.when(F.col("kind") == "event", F.col("event")).alias("event"),
                       F.when(F.col("kind") == "match", F.col("record")).alias("record"), "kind")
    kept.write.mode("overwrite").partitionBy("kind").parquet(f"{store.root}/archive/batch_id={batch_id}")


def _later(a: str | None, b: str | None) -> str | None:
    return max(filter(None, (a, b)), default=None)


def _freeze_through(newest: str | None, through: str | None, horizon_days: int | None, freeze_days: int) -> str | None:
    """The date up to which matches are frozen once ``newest`` has been seen."""
    if newest is None or horizon_days is None:
        return through
    due = dt.date.fromisoformat(newest) - dt.timedelta(days=horizon_days)
    if through is None or (due - dt.date.fromisoformat(through)).days >= freeze_days:
        return due.isoformat()
    return through


def _day(text: str | None):
    return F.lit(text).cast("date")


def _records(store: Store, last: Commit, new: DataFrame, through: str | None) -> DataFrame:
    """The record that counts of each open match."""
    both = store.hot(last, "records").unionByName(new)
    rest = [c for c in both.columns if c != "match_id"]
    tie = F.xxhash64("label", "winner", "match_date", "duration", "venue", "gameweek")
    one = (both.groupBy("match_id").agg(F.max_by(F.struct(*rest), F.struct("arrival", "batch", tie)).alias("r"))
           .select("match_id", *[F.col(f"r.{c}").alias(c) for c in rest]))
    done = F.lit(False) if through is None else F.col("match_date") <= _day(through)
    return one.withColumn("part", F.when(done, "done").otherwise("hot"))


def _counts(store: Store, last: Commit, events: DataFrame, records: DataFrame, gone: int) -> DataFrame:
    """The metric counts of the open matches, those that have no record yet included; of
    these, the ones first met up to batch ``gone`` are orphans."""
    new = _metrics.metric_counts(events, also=[F.min("batch_id").alias("first_batch")])
    sums = (store.hot(last, "counts").unionByName(new).groupBy("match_id", "player_id")
            .agg(*[F.sum(c).cast("bigint").alias(c) for c in _metrics.COUNT_COLUMNS], F.min("first_batch").alias("first_batch")))
    dated = sums.join(records.select("match_id", F.col("part").alias("closed")), "match_id", "left")
    return dated.withColumn("part", F.coalesce("closed", F.when(F.col("first_batch") <= gone, "orphan").otherwise("hot"))).drop("closed")


def last_ratings(base: DataFrame) -> DataFrame:
    """(player_id, rating): of a player's rows, the rating of the last match."""
    return base.groupBy("player_id").agg(F.max_by("rating", F.struct("match_date", "match_id")).alias("rating"))


def _frozen_sums(store: Store, last: Commit, batch_id: int, facts: DataFrame, ratings: DataFrame, counts: DataFrame) -> dict[str, list[int]]:
    """Adds up what batch ``batch_id`` freezes; merges the parts of a table that has many."""
    gone = counts.filter(F.col("part") != "hot")
    first = gone.agg(F.min("first_batch")).first()[0]
    events = store.archive("event", batch_id if first is None else first, batch_id).select("event.*")
    passes = _metrics.stream_pass_totals(_metrics.stream_pass_sums(events.join(gone.select("match_id").distinct(), "match_id", "left_semi")))
    made = {
        "base": ratings.groupBy("player_id").agg(F.max_by(F.struct("match_date", "match_id", "rating"), F.struct("match_date", "match_id")).alias("r"))
        .select("player_id", "r.*"),
        "totals": _facts.career_sums(facts),
        "pairs": _chem.pair_sums(_chem.match_pair_steps(ratings)),
        "passes": passes,
    }
    parts, writes = {}, []
    for table, new in made.items():
        before = last.parts.get(table, [])
        if len(before) >= COMPACT_PARTS:
            new, before = merged(table, store.sums(last, table).unionByName(new)), []
        writes.append(lambda new=new, table=table: store.write(new, f"{table}/batch_id={batch_id}"))
        parts[table] = [*before, batch_id]
    _together(store.spark, *writes)
    return parts


def _together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Runs the writes of a batch that do not need each other at the same time: most of a
    small batch's time is planning and committing."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()


def merged(table: str, rows: DataFrame) -> DataFrame:
    """One row per key of a table of sums."""
    if table == "base":
        rest = F.struct("match_date", "match_id", "rating")
        return rows.groupBy("player_id").agg(F.max_by(rest, F.struct("match_date", "match_id")).alias("r")).select("player_id", "r.*")
    keys = [c for c in rows.columns if c.startswith("player_id")]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])


def handle_batch(root: str, horizon_days: int | None = HORIZON_DAYS, freeze_days: int = FREEZE_DAYS):
    """The ``foreachBatch`` function writing into the store folder ``root``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = Store(spark, root)
        last = store.commit()
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if last.query and query and last.query != query:
            raise RuntimeError(f"the store {root} was written by another query; a new checkpoint needs a new store")
        if batch_id <= last.batch:
            return
        _archive(store, batch, batch_id)
        came = store.archived_batch("match", batch_id).select("record.*", F.col("batch_id").alias("batch"))
        late = F.lit(False) if last.through is None else F.col("match_date") <= _day(last.through)
        seen = came.agg(F.max("match_date").cast("string").alias("newest"), F.count(F.when(late, 1)).alias("late")).first()
        newest = _later(last.newest, seen.newest)
        through = _freeze_through(newest, last.through, horizon_days, freeze_days)
        # batches after which the newest date was in the frozen part: what they met first is given up
        moved = last.seen if newest == last.newest else [*last.seen, [batch_id, newest]]
        moved = [m for m in moved if through is None or m[1] > through]
        gone = moved[0][0] - 1 if through is not None else -1
        if seen.late:
            store.write(came.filter(late).drop("batch"), f"late_records/batch_id={batch_id}")

        hot = f"hot/batch_id={batch_id}"
        # a record dated in the frozen part is late, whether or not its match was known
        records = _records(store, last, came.filter(~late), through)
        events = store.archived_batch("event", batch_id).select("event.*", "batch_id")
        counts = _counts(store, last, events, records, gone)
        part = F.when(F.lit(False) if through is None else F.col("match_date") <= _day(through), "done").otherwise("hot").alias("part")
        metrics = _metrics.metrics_from_counts(counts.filter(F.col("part") != "orphan"))
        closed = _facts.match_facts(_squads.participants(records.drop("part", "batch"), unique=True), metrics).select("*", part)
        # the open matches' state is small: facts are computed beside its writing, not after it
        _together(spark, lambda: store.write(records, f"{hot}/records", by_part=True), lambda: store.write(counts, f"{hot}/counts", by_part=True),
                  lambda: store.write(closed, f"facts/batch_id={batch_id}", by_part=True))
        facts = store.read("facts", f"facts/batch_id={batch_id}", "*")
        rated = _ratings.rating_history(facts, carry=("team_pos", "squad"), base=last_ratings(store.sums(last, "base")))
        store.write(rated.select("*", part), f"ratings/batch_id={batch_id}", by_part=True)

        parts = last.parts
        if through != last.through:
            ratings = store.read("ratings", f"ratings/batch_id={batch_id}", "done")
            counts = store.read("counts", f"{hot}/counts", "*")
            parts = _frozen_sums(store, last, batch_id, facts.filter("part = 'done'"), ratings, counts)
            store.write(counts.filter("part = 'orphan'").drop("part"), f"orphans/batch_id={batch_id}")
        store.publish(Commit(batch_id, query or last.query, newest, through, parts, moved))

    return run


def start_ingest(lines: DataFrame, store: str, checkpoint_location: str, *,
                 available_now: bool = False, processing_time: str = "2 seconds",
                 horizon_days: int | None = HORIZON_DAYS, freeze_days: int = FREEZE_DAYS) -> StreamingQuery:
    """Starts the ingestion query: micro-batches every ``processing_time`` (the
    source used 2 s batches), or all available input then stop (``available_now``)."""
    w = (lines.writeStream.foreachBatch(handle_batch(store, horizon_days, freeze_days))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def run_for(query: StreamingQuery, seconds: float | None) -> None:
    """Bounded run: wait for the query to finish or for ``seconds``, then stop it
    gracefully (the running micro-batch completes; its output is idempotent)."""
    query.awaitTermination(seconds) if seconds is not None else query.awaitTermination()
    query.stop()
    if query.exception() is not None:
        raise query.exception()


# --- reading the store ----------------------------------------------------------------------

def latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: of the latest batch (``batch_id``) that has one."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def season_from_store(spark: SparkSession, store: str, players: DataFrame, teams: DataFrame,
                      requests: DataFrame | None = None, include_late: bool = False):
    """The season of an ingestion store: archived events, the record of each match that
    counts, and the facts and ratings the stream closed (not recomputed).  With
    ``include_late`` facts and ratings are computed from the archive instead, so that what
    came for frozen matches counts too."""
    from ..plans.season import Season
    s = Season(events=lambda: stored_table(spark, store, "events"),
               matches=lambda: stored_matches(spark, store), players=players, teams=teams, requests=requests)
    if not include_late:
        s.__dict__["match_facts"] = stored_facts(spark, store)
        s.__dict__["ratings"] = stored_ratings(spark, store)
    return s


def stored_facts(spark: SparkSession, store: str) -> DataFrame:
    """Match facts of the store, frozen and open, as of its newest commit."""
    s = Store(spark, store)
    return s.history(s.commit(), "facts")


def stored_ratings(spark: SparkSession, store: str) -> DataFrame:
    s = Store(spark, store)
    return s.history(s.commit(), "ratings")


def stored_table(spark: SparkSession, store: str, table: str) -> DataFrame:
    """'events', 'matches' (all records) or 'rejects' (value, kind) of committed batches."""
    s = Store(spark, store)
    last = s.commit().batch
    if table == "rejects":
        parts = [s.archive(kind, 0, last).select("value", "kind") for kind in ("corrupt", "other", "undated")]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
    kind, field = {"events": ("event", "event"), "matches": ("match", "record")}[table]
    return s.archive(kind, 0, last).select(f"{field}.*")


def stored_matches(spark: SparkSession, store: str) -> DataFrame:
    """The record of each match that counts: the largest arrival, of equal ones the last batch's."""
    s = Store(spark, store)
    rows = s.archive("match", 0, s.commit().batch).select("record.*", "batch_id")
    rest = [c for c in rows.columns if c not in ("match_id", "batch_id")]
    tie = F.xxhash64("label", "winner", "match_date", "duration", "venue", "gameweek")
    return (rows.groupBy("match_id").agg(F.max_by(F.struct(*rest), F.struct("arrival", "batch_id", tie)).alias("r"))
            .select("match_id", *[F.col(f"r.{c}").alias(c) for c in rest]))


__all__ = ["record_stream", "start_ingest", "handle_batch", "run_for", "season_from_store", "stored_facts", "stored_ratings",
           "stored_table", "stored_matches", "latest"]
