"""Chat formatting against plain Python and DuckDB."""

import random

import duckdb

from pitchmetrics.llm import chat, queries


def _plain(rows):
    convs = {}
    for c, n, r, t in set((c, n, r or "", t or "") for c, n, r, t in rows):
        convs.setdefault(c, []).append((n is not None, n or 0, r, t))
    lists = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    out = set()
    for c, turns in lists.items():
        n = len(turns)
        if any(len(o) > n and o[:n] == turns for o in lists.values()):
            continue
        equal = sorted((k for k, o in lists.items() if o == turns), key=lambda k: (k is not None, k))
        if equal[0] != c:
            continue
        for part in range(0, n, chat.PART):
            some = turns[part:part + chat.PART]
            out.add((c, part // chat.PART, n, len(equal), len(some), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in some)))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, n_turns string"


def test_snapshots(spark):
    rng = random.Random(1)
    rows = []
    for c in range(200):
        base = rng.randrange(12)
        for n in range(rng.randrange(1, 7)):
            rows.append((c, n * 3, ("user", "assistant")[n % 2], f"{base} {n} {rng.randrange(20) if n > 3 else ''}"))
    rows += [(500, n, "user", f"long {n}") for n in range(1500)] + [(501, n, "user", f"long {n}") for n in range(700)]
    rows += [(502, n, "user", f"long {n}") for n in range(1500)]
    rows += [(600, None, None, "a"), (600, 1, "user", None), (600, 1, "user", "b"), (600, 1, "user", "b"), (None, 0, "user", "x"), (None, 1, "user", "y"),
             (601, 0, "user", "x"), (602, 0, "user", "x"), (602, 1, "user", "y")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(4)
    got = chat.format_chats(df).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == _plain(rows)
    assert chat.format_chats(df.limit(0)).collect() == []


def test_query_matches_sql_and_is_native(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op2_chat_format(spark, sf)
    got = sorted(tuple(r) for r in out.collect())
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    assert got == sorted(con.sql(queries.ORACLE["op2_chat_format"]).fetchall()) and got
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))
