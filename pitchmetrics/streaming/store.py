"""The ingestion store: tables in folders, and commits that say which of them count.

    archive/batch_id=b/kind=...      every line of batch b, parsed once (never read by later batches)
    hot/batch_id=b/counts, records   the open matches after batch b, whole (a generation)
    facts, ratings/batch_id=b/part=  'hot': of the open matches after batch b; 'done': frozen in batch b
    base, totals, pairs, passes/batch_id=b   sums of what batch b froze, a part each
    late_records, orphans/batch_id=b side tables
    commits/00000000b.json           written last, by renaming a finished file

Readers take the newest commit and read only what it names, so they see a batch whole or
not at all; a batch that failed left no commit, and its replay overwrites its folders.  A
generation holds the open matches only, and parts are merged once there are
``COMPACT_PARTS`` of them, so that what a batch reads and writes does not grow with the
history of the stream.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import metrics as _metrics

#: parts of a table of sums that are merged into one
COMPACT_PARTS = 16
#: commits and generations that stay for readers which began earlier
KEPT = 3

_RECORDS = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.MATCH_RECORDS.fields)
COUNTS = ("match_id string, player_id string, " + ", ".join(f"{c} bigint" for c in _metrics.COUNT_COLUMNS)
          + ", first_batch int")
FACTS = ("match_id string, player_id string, match_date date, team_pos int, team_id string, squad string, squad_index int, "
         "minutes_played int, goals int, own_goals int, yellow_cards int, red_cards int, "
         + ", ".join(f"{c} {'bigint' if c.startswith('n') else 'double'}" for c in _metrics.METRIC_COLUMNS)
         + ", player_contribution double, player_performance double")
SCHEMAS = {
    "records": _RECORDS + ", batch int",
    "counts": COUNTS,
    "facts": FACTS,
    "ratings": "player_id string, match_date date, match_id string, team_pos string, squad string, old_rating double, "
               "rating double, change_in_rating double",
    "base": "player_id string, match_date date, match_id string, rating double",
    "totals": "player_id string, number_of_fouls bigint, number_of_goals bigint, number_of_own_goals bigint, "
              "number_of_shots_on_target bigint, number_of_matches bigint",
    "pairs": "player_id_1 string, player_id_2 string, steps double",
    "passes": "player_id string, numerator bigint, denominator bigint",
    "late_records": _RECORDS,
    "orphans": COUNTS,
}
ARCHIVE = ("value string, event struct<" + ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in schemas.EVENTS.fields)
           + ">, record struct<" + ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in schemas.MATCH_RECORDS.fields) + ">")
EVENT_FIELDS = tuple(schemas.EVENTS.fieldNames())
MATCH_FIELDS = tuple(schemas.MATCH_RECORDS.fieldNames())


@dataclass
class Commit:
    """The state of the store after a batch."""

    batch: int = -1
    query: str | None = None                 # id of the streaming query that wrote it
    newest: str | None = None                # the latest match date so far
    through: str | None = None               # matches up to this date are frozen
    parts: dict[str, list[int]] = field(default_factory=dict)
    seen: list[list] = field(default_factory=list)   # [batch, newest] where a batch moved it past ``through``


class Store:
    """The folder ``root`` through Hadoop's file system, wherever Spark can write."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    # --- commits ----------------------------------------------------------------------
    def commit(self) -> Commit:
        """The newest commit; the state before the first batch where there is none."""
        found = sorted(n for n in self._names("commits") if n.endswith(".json"))
        if not found:
            return Commit()
        stream = self._fs.open(self._path(f"commits/{found[-1]}"))
        try:
            return Commit(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def publish(self, commit: Commit) -> None:
        """Makes ``commit`` the newest, at once; then removes generations no reader needs."""
        name = f"commits/{commit.batch:012d}.json"
        out = self._fs.create(self._path(name + ".tmp"), True)
        out.write(bytearray(json.dumps(asdict(commit)).encode()))
        out.close()
        if not self._fs.rename(self._path(name + ".tmp"), self._path(name)):
            raise RuntimeError(f"commit {name} could not be published")
        old = commit.batch - KEPT
        if old >= 0:
            self.remove(f"commits/{old:012d}.json")
            self.remove(f"hot/batch_id={old}")
            for table in ("facts", "ratings"):
                self.remove(f"{table}/batch_id={old}/part=hot")

    # --- tables -----------------------------------------------------------------------
    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[table])

    def read(self, table: str, name: str, part: str | None = None) -> DataFrame:
        """The table in the folder ``name``, of ``part`` where it is dealt by part."""
        schema = SCHEMAS[table] + (", part string" if part else "")
        df = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return df.filter(F.col("part") == part).drop("part") if part and part != "*" else df

    def hot(self, commit: Commit, table: str) -> DataFrame:
        """``counts`` or ``records`` of the open matches."""
        return self.read(table, f"hot/batch_id={commit.batch}/{table}", "hot") if commit.batch >= 0 else self.empty(table)

    def history(self, commit: Commit, table: str) -> DataFrame:
        """``facts`` or ``ratings`` of all matches: frozen ones, and the open ones as of the commit."""
        if commit.batch < 0:
            return self.empty(table)
        df = self.spark.read.schema(SCHEMAS[table] + ", part string, batch_id int").parquet(f"{self.root}/{table}")
        counts = ((F.col("part") == "done") & (F.col("batch_id") <= commit.batch)
                  | (F.col("part") == "hot") & (F.col("batch_id") == commit.batch))
        return df.filter(counts).drop("part", "batch_id")

    def sums(self, commit: Commit, table: str) -> DataFrame:
        """All parts of a table of sums."""
        batches = commit.parts.get(table, [])
        if not batches:
            return self.empty(table)
        return self.spark.read.schema(SCHEMAS[table]).parquet(*[f"{self.root}/{table}/batch_id={b}" for b in batches])

    def side(self, commit: Commit, table: str) -> DataFrame:
        """A side table: ``late_records`` or ``orphans``."""
        if not self.exists(table):
            return self.empty(table)
        df = self.spark.read.schema(SCHEMAS[table] + ", batch_id int").parquet(f"{self.root}/{table}")
        return df.filter(F.col("batch_id") <= commit.batch).drop("batch_id")

    def write(self, df: DataFrame, name: str, by_part: bool = False) -> None:
        writer = df.write.mode("overwrite")
        (writer.partitionBy("part") if by_part else writer).parquet(f"{self.root}/{name}")

    # --- archive ----------------------------------------------------------------------
    def archive(self, kind: str, first: int = 0, last: int | None = None) -> DataFrame:
        """Archived lines of a kind ('event', 'match', ...) of the batches first to last."""
        schema = ARCHIVE + ", batch_id int, kind string"
        if not self.exists("archive"):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(f"{self.root}/archive").filter((F.col("kind") == kind) & (F.col("batch_id") >= first))
        return df if last is None else df.filter(F.col("batch_id") <= last)

    def archived_batch(self, kind: str, batch_id: int) -> DataFrame:
        """The same of one batch, without listing the others.  Its number is a column read from
        the path: as a literal it would be compiled into new code for every batch."""
        reader = self.spark.read.schema(ARCHIVE + ", batch_id int, kind string").option("basePath", f"{self.root}/archive")
        return reader.parquet(f"{self.root}/archive/batch_id={batch_id}").filter(F.col("kind") == kind)
