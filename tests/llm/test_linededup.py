"""Line dedup against DuckDB and a plain-Python version."""

import random

import duckdb

from pitchmetrics.llm import linededup, queries


def _plain(rows):
    """{(key, text): cleaned} of rows with distinct keys."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        lines, gone = text.split("\n"), set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p:p + 3])
            if not "".join(window).strip(" \t\r"):
                continue
            if window in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(window)
        out[key] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def test_random_texts(spark):
    rng = random.Random(1)
    rows = [(k, "\n".join(rng.choice(["a", "b", "c d", "", " ", "e\r"]) for _ in range(rng.randrange(1, 14)))) for k in range(150)]
    rows.append((999, "\n".join(rng.choice("xyz") for _ in range(20000))))
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == _plain(rows)


def test_edge_cases(spark):
    rows = [(1, None, "z"), (2, "", "z"), (3, "a\nb\nc\nd", "z"), (3, "a\nb\nc\nd", "z"), (None, "a\nb\nc", "z"),
            (4, "x\na\nb\nc", "z"), (5, "\n\n\n", "z"), (6, "\n\n\n", "z"), (7, "a\nb", "z"), (8, "a\nb", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    out = linededup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "n_lines", "n_removed"]
    got = sorted(((r.doc_id or 0), r.text, r.n_lines, r.n_removed) for r in out.collect() if r.doc_id != 1)
    assert got == [(0, "a\nb\nc", 3, 0), (2, "", 1, 0), (3, "d", 4, 3), (3, "d", 4, 3), (4, "x", 4, 3), (5, "\n\n\n", 4, 0),
                   (6, "\n\n\n", 4, 0), (7, "a\nb", 2, 0), (8, "a\nb", 2, 0)]
    assert [tuple(r) for r in out.filter("doc_id = 1").collect()] == [(1, None, 0, 0)]
    assert linededup.dedup_lines(df.limit(0)).collect() == []


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, queries.op3_line_dedup(spark, sf).select("doc_id", "text", "n_lines", "n_removed").collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.sql(queries.ORACLE["op3_line_dedup"]).fetchall())
    assert got == want and sum(r[3] for r in got) > 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = linededup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))
