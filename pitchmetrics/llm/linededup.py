"""Line deduplication over overlapping windows of three consecutive lines.

Every window of a text is hashed to 128 bits.  A window that occurs again anywhere stays
where it comes first, in the order of key and position; at every later place its lines
are covered, covered positions are merged, and covered lines go.  The earliest instance
of a line is never covered, so no content is lost altogether.

Windows are summed up per task before they meet, and a text only meets the list of its
own covered positions.

Defined cases: a text of fewer lines than a window has none and stays; a null text stays
null; windows of blank lines alone (spaces, tabs, carriage returns) do not count; rows
that agree in key and text count as one document and get the same result; rows that
share a key but not the text are ordered by a hash of the text; a null key comes first;
a text whose lines all go is empty; an empty table gives an empty one.  Added columns
(``n_lines``, ``n_removed``) replace input columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _windows(df: DataFrame) -> DataFrame:
    """(_a, _b, _key, _pos, _x, _y): document identity, order, and window hash."""
    lines = df.select("_a", "_b", "_key", F.split("_text", "\n").alias("l"))
    shifted = F.arrays_zip(*[F.slice("l", i + 1, F.greatest(F.size("l") - i, F.lit(0))).alias(f"w{i}") for i in range(WINDOW)])
    placed = lines.select("_a", "_b", "_key", F.posexplode(shifted).alias("_pos", "w"))
    parts = [F.col(f"w.w{i}") for i in range(WINDOW)]
    return (placed.filter(parts[-1].isNotNull() & (F.length(F.btrim(F.concat(*parts), F.lit(" \t\r"))) > 0))
            .select("_a", "_b", "_key", "_pos", F.xxhash64(*parts).alias("_x"), F.xxhash64(F.lit("window"), *parts).alias("_y")))


def _covered(windows: DataFrame) -> DataFrame:
    """(_a, _b, starts): the sorted starts of each document's windows that came before."""
    place = F.struct("_key", "_a", "_b", "_pos")
    first = (windows.groupBy("_x", "_y").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
             .filter("_n > 1").select("_x", "_y", "_first"))
    later = windows.join(first, ["_x", "_y"]).filter(place > F.col("_first"))
    return later.groupBy("_a", "_b").agg(F.sort_array(F.collect_set("_pos")).alias("_starts"))


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``text`` cleaned, and n_lines (before) and n_removed."""
    t = F.col(text).cast("string")
    named = df.select("*", F.col(key).alias("_key"), t.alias("_text"), F.xxhash64(F.col(key), t).alias("_a"),
                      F.xxhash64(F.lit("row"), F.col(key), t).alias("_b"))
    covered = _covered(_windows(named))
    met = named.join(covered, ["_a", "_b"], "left").withColumn("_lines", F.split("_text", "\n"))
    # an uncovered stretch and then a covered one for each start; the ends overlap where starts are near
    ends = F.concat(F.array(F.lit(0)), F.transform("_starts", lambda p: p + WINDOW))
    flags = F.flatten(F.transform(
        F.filter(F.arrays_zip(F.col("_starts").alias("p"), ends.alias("e")), lambda x: x["p"].isNotNull()),
        lambda x: F.concat(F.array_repeat(F.lit(False), F.greatest(x["p"] - x["e"], F.lit(0))),
                           F.array_repeat(F.lit(True), WINDOW - F.greatest(x["e"] - x["p"], F.lit(0))))))
    kept = F.transform(F.filter(F.arrays_zip(F.col("_lines").alias("line"), F.col("_flags").alias("gone")),
                                lambda x: ~F.coalesce(x["gone"], F.lit(False))), lambda x: x["line"])
    marked = met.withColumn("_flags", flags).withColumn("_kept", F.when(F.col("_starts").isNull(), F.col("_lines")).otherwise(kept))
    n = F.when(F.col("_text").isNull(), 0).otherwise(F.size("_lines"))
    out = {text: F.when(F.col("_starts").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n")),
           "n_lines": n, "n_removed": F.when(F.col("_starts").isNull(), 0).otherwise(F.size("_lines") - F.size("_kept"))}
    return marked.select(*[out.pop(c).alias(c) if c in out else F.col(c) for c in df.columns],
                         *[v.alias(k) for k, v in list(out.items())])


def sql(source: str, key: str = "doc_id", text: str = "text") -> str:
    """DuckDB SQL for key, the cleaned text, n_lines and n_removed over ``source``."""
    blank = "trim(l[p] || l[p + 1] || l[p + 2], ' ' || chr(9) || chr(13)) = ''"
    return f"""
WITH d AS (SELECT {key} AS k, {text} AS t, string_split({text}, chr(10)) AS l FROM {source}),
w AS (SELECT k, l, unnest(range(1, len(l) - 1)) AS p FROM d WHERE len(l) >= 3),
r AS (SELECT k, p, row_number() OVER (PARTITION BY l[p], l[p + 1], l[p + 2] ORDER BY k, p) AS nth FROM w WHERE NOT ({blank})),
c AS (SELECT DISTINCT k, unnest([p, p + 1, p + 2]) AS p FROM r WHERE nth > 1),
x AS (SELECT k, t, l, unnest(range(1, len(l) + 1)) AS p FROM d),
g AS (SELECT x.k, any_value(x.t) AS t, string_agg(x.l[x.p], chr(10) ORDER BY x.p) FILTER (WHERE c.p IS NULL) AS kept,
             count(*) AS n_lines, count(c.p) AS n_removed FROM x LEFT JOIN c ON x.k = c.k AND x.p = c.p GROUP BY x.k)
SELECT k AS {key}, coalesce(kept, '') AS {text}, n_lines, n_removed FROM g
UNION ALL SELECT k, t, 0, 0 FROM d WHERE t IS NULL"""
