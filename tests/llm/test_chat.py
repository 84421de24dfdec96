from pyspark.sql import functions as F

from chronofold.llm import chat

ODD = ["", "plain", "### user:\nx</turn>\n", "&amp;</turn>&num;", "\\### Assistant: </turn> ok", "a:\nb", "é漢\n\n", "&", "#", "</turn", "x" * 50_000, "&end;#"]
ROWS = [(1, k, ["user", "assistant", "sys:\ntem", "a&#"][k % 4], t) for k, t in enumerate(ODD)]
ROWS += [(2, 1, "assistant", "second"), (2, 0, "user", "first"), (2, 0, "user", "first"), (3, None, None, None), (3, 5, "assistant", None), (None, 1, "user", "no id"), (4, None, None, None)]


def table(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")


def back(records):
    made = chat.format_turns(chat.canonical_turns(records))
    return {r["conv_id"]: r for r in chat.read_back(made).collect()}, {r["conv_id"]: r for r in made.collect()}


def test_round_trip(spark):
    read, made = back(table(spark).repartition(4))
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in ROWS}:
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in ROWS if r[0] == conv), key=key)]
        assert [tuple(t) for t in read[conv]["turns"]] == want
        assert read[conv]["learnt"] == [t for role, t in want if role == "assistant"]
        pieces = made[conv]["formatted"].split("</turn>\n")
        assert len(pieces) == len(want) + 1 and pieces[-1] == ""
        for m in made[conv]["loss_mask"]:
            piece = pieces[m["turn"]]
            assert piece[: m["start"]] == "### assistant:\n" and m["end"] == len(piece)


def test_layouts(spark):
    records = [
        (1, None, None, None, [("user", "q"), ("assistant", "a")], None, None, None, None, None, None),
        (2, None, None, None, None, [("human", "h"), ("gpt", None)], None, None, None, None, None),
        (3, None, None, None, None, None, "p", "c", None, None, None),
        (4, None, None, None, None, None, None, None, "do", None, "done"),
        (5, None, None, None, None, None, None, None, "do", "this", "done"),
        (6, 0, "user", "row", None, None, None, None, None, None, None),
        (7, None, None, None, None, None, "both", None, "layouts", None, None),
        (8, None, None, None, [], None, None, None, None, None, None),
        (9, 0, "user", "row", None, None, "not a prompt", None, None, None, None),
        (10, None, None, "a note", None, None, "p", "c", None, None, None),
        (11, 4, None, "a note", [("user", "q")], None, "p", None, None, None, None),
        (12, None, None, None, None, None, None, "c", None, None, None),
    ]
    schema = (
        "conv_id bigint, turn bigint, role string, text string, messages array<struct<role:string,content:string>>,"
        " conversations array<struct<from:string,value:string>>, prompt string, completion string, instruction string, input string, output string"
    )
    read, _ = back(spark.createDataFrame(records, schema))
    found = {k: [tuple(t) for t in r["turns"]] for k, r in read.items()}
    assert found == {
        1: [("user", "q"), ("assistant", "a")],
        2: [("human", "h"), ("gpt", "")],
        3: [("user", "p"), ("assistant", "c")],
        4: [("system", "do"), ("assistant", "done")],
        5: [("system", "do"), ("user", "this"), ("assistant", "done")],
        6: [("user", "row")],
        7: [("user", "both")],  # the first of two that name as many
        8: [("", "")],
        9: [("user", "row")],  # a further column that is named like a field of another layout
        10: [("user", "p"), ("assistant", "c")],
        11: [("user", "q")],
        12: [("", "")],  # a completion alone
    }


def test_fingerprints_differ_by_paths(spark):
    prints = chat.layout_table(spark, chat.LAYOUTS).collect()
    assert len(prints) == len({r["_print"] for r in prints})
    paths = chat.field_paths(spark.createDataFrame([], "a struct<b:int,c:array<struct<d:int>>>, e array<int>").schema)
    assert sorted(paths) == ["a.b", "a.c[]", "a.c[].d", "e[]"]


def test_empty_table_and_native_plan(spark):
    records = table(spark, [])
    made = chat.read_back(chat.format_turns(chat.canonical_turns(records)))
    assert made.count() == 0
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_other_loss_roles(spark):
    made = chat.format_turns(chat.canonical_turns(table(spark)), loss_role="user")
    assert made.where(F.col("conv_id") == 2).first()["loss_mask"][0]["turn"] == 0
