from __future__ import annotations

import random
import re

import duckdb

from tierlake.llm import chat
from tierlake.llm.queries import CHAT_SQL, op10_chat

SF = "/root/testdata/sf0.01"
TURNS = "conv_id bigint, turn int, role string, text string, hashes string, a bigint"


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = sorted(connection.sql(CHAT_SQL).fetchall())
    assert sorted(map(tuple, op10_chat(spark, SF).collect())) == want


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)


def test_brute_force(spark):
    rng = random.Random(1)
    chats = {i: [(rng.choice("ua"), rng.choice("xy")) for _ in range(rng.randint(1, 6))]
             for i in range(150)}
    rows = [(i, t, *turn) for i, turns in chats.items() for t, turn in enumerate(turns)]
    rng.shuffle(rows)
    keep = {i for i, a in chats.items()
            if not any(len(b) > len(a) and b[:len(a)] == a for b in chats.values())
            and not any(b == a and k < i for k, b in chats.items())}
    got = {r.conv_id: r for r in chat.format_chats(_table(spark, rows)).collect()}
    assert set(got) == keep
    for i in keep:
        assert got[i].n_turns == len(chats[i])
        assert got[i].chat == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in chats[i])


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "a"), (2, 0, "user", ""), (2, 1, None, "a"),
            (3, 0, "user", "x"), (3, 0, "user", "x"), (3, 0, "user", "w"), (None, 0, "user", "z"),
            (4, None, "user", "q"), (4, 1, "user", "r"), (5, 0, None, "a"), (6, 0, "a", None),
            (7, 0, "unknown", "a"), (8, 0, "user", "y" * 100_000)]
    got = {r.conv_id: r for r in chat.format_chats(_table(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8}, "null and empty differ, so none is a copy"
    assert got[1].chat == "<|im_start|>user\n<|im_end|>\n<|im_start|>unknown\na<|im_end|>\n"
    assert got[3].n_turns == 2 and got[3].chat.index("\nw<") < got[3].chat.index("\nx<")
    assert got[4].chat.index("\nq<") < got[4].chat.index("\nr<")
    assert chat.format_chats(_table(spark, rows).limit(0)).count() == 0


def test_is_native(spark):
    plan = chat.maximal(chat.gathered(_table(spark, [(1, 0, "u", "x")])))
    assert not re.search("Python|Pandas|Arrow",
                         plan._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", ""))
