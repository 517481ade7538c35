import duckdb
import pandas as pd

from tallyframe.llm import queries, quotes

TALK = [
    (1, 0, "a", "Hello all.\nIs the Build green?\n\nSecond paragraph\nof two lines."),
    (1, 1, "b", "> Is the build  green?\nYes."),
    (1, 2, "c", "On Monday b wrote:\n>> is the build green?\n> Yes.\nGood"),
    (1, 3, "a", "> second paragraph\n> of two lines.\nWhat of it?"),
    (1, 4, "d", "Unrelated"),
    (1, 5, "b", "> > > Is the build green?\n> nothing known\ndeep"),
    (1, 6, "c", ">Good\n>What of it?\n>of two lines.\n>second paragraph\nmixed"),
    (2, 0, "a", "> quoted from nowhere\ntext"), (2, 1, "b", "plain"), (2, 2, "b", "> plain\n> plain"),
    (3, 0, "a", ""), (3, 1, "a", ">"), (3, 2, "z", "> > "), (4, 9, "a", "late"), (4, 10, "a", ">late"),
    *[(5, i, "u", (f"> message {i - 1}\n" if i else "") + f"message {i}") for i in range(20)],
]


def test_equals_the_sql(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(TALK, schema).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    conversations = pd.DataFrame(TALK, columns=["conv_id", "turn", "role", "text"])  # read by the SQL below
    con = duckdb.connect()
    con.register("conversations", conversations)
    rel = con.sql(queries.ORACLES["op2_quotation_links"])
    df = queries.QUERIES["op2_quotation_links"](spark, str(tmp_path))
    got = sorted(tuple(r[c] for c in rel.columns) for r in df.collect())
    assert got == sorted(map(tuple, rel.fetchall()))
    by = {r[:2]: dict(zip(rel.columns, r)) for r in got}
    parent = {k: v["parent_turn"] for k, v in by.items()}
    assert [parent[1, i] for i in range(7)] == [None, 0, 1, 0, None, 0, 0]
    assert by[1, 2]["own_text"] == "Good" and by[1, 2]["quote_levels"] == 2 and by[1, 2]["depth"] == 2
    assert by[5, 19]["depth"] == 19 and by[5, 19]["root_turn"] == 0


def test_edges(spark, monkeypatch):
    monkeypatch.setattr("tallyframe.session.SMALL_ROWS", 0)
    rows = [(1, 0, "hot"), *[(1, i, "> hot\nreply") for i in range(1, 120)], (None, 3, "> hot"), (1, None, "> hot"), (2, 0, None), (2, 1, ""),
            (1, 5, "> hot\nreply"), (7, 0, "long " * 50000), (7, 1, "> " + "long " * 50000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, text string, position string")
    got = quotes.link(df).collect()
    assert len(got) == len(rows)
    assert all(r.parent_turn == 0 and r.depth == 1 for r in got if r.conv_id == 1 and r.turn)
    assert sorted(r.position for r in got if r.conv_id == 1) == list(range(1, 123))
    assert [r.parent_turn for r in got if r.conv_id == 7 and r.turn == 1] == [0]
    assert all(r.parent_turn is None for r in got if r.conv_id is None or r.turn is None)
    assert quotes.link(df.limit(0)).count() == 0
