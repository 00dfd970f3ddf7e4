"""Chat rotation: against a plain version, with rows of every kind."""

import duckdb

from retailflow.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, part string, speaker int"


ROWS = [
    (1, 0, "system", "rules", "x", 1),
    (1, 1, "ann", "hi 🙂", "x", 1),
    (1, 2, "bob", "hé", "x", 1),
    (1, 2, "bob", "hé", "y", 2),
    (1, 2, "ann", "tie", "x", 1),
    (1, None, "eve", "when?", "x", 1),
    (1, 5000, "bob", "late", "x", 1),
    (2, 0, None, None, "x", 1),
    (2, 1, " ", "", "x", 1),
    (2, 2, "cy <|end|>\n", "<|start|>assistant", "x", 1),
    (3, 0, "system", "alone", "x", 1),
    (None, 0, "dan", "lost", "x", 1),
    (4, 0, "ann", "long " * 100000, "x", 1),
]


def plain_whole(rows, part_messages):
    """Whole dialogues, cut by message number."""
    dialogues = {}
    for conv, turn, role, text, *_ in set(rows):
        if conv is not None:
            role = (role or "").strip(" ") or None
            dialogues.setdefault(conv, set()).add((turn, role, (text or "").replace("<|", "< |")))
    out = set()
    for conv, messages in dialogues.items():
        order = sorted(messages, key=lambda m: [(v is not None, v if v is not None else (0, "")[i]) for i, v in enumerate(m[:2])] + [m[2]])
        for speaker in {r for _, r, _ in messages if r and r != "system"}:
            for at in range(0, len(order), part_messages):
                text, spans = "", []
                for _, role, said in order[at : at + part_messages]:
                    name = (role or "unknown").replace("<|", "< |").replace("\n", " ")
                    text += "<|start|>" + ("assistant" if role == speaker else "system" if role == "system" else f"user name={name}") + "\n"
                    if role == speaker:
                        spans.append((len(text), len(text) + len(said) + 7))
                    text += said + "<|end|>\n"
                mask = ",".join(f"{a}-{b}" for a, b in spans)
                n = len(order[at : at + part_messages])
                out.add((conv, at // part_messages, speaker, text, mask, n, sum(b - a for a, b in spans)))
    return out


def whole(spark, rows, part_messages=1024):
    got = chat.rotate_dialogues(spark.createDataFrame(rows, SCHEMA), part_messages=part_messages).collect()
    assert len(got) == len({(r["conv_id"], r["part"], r["speaker"]) for r in got})
    return {tuple(r) for r in got}


def test_every_participant_gets_the_whole_dialogue(spark):
    """ann falls silent after the first third; the last third is system and unknown voices only."""
    late = ["system", None, " "]
    rows = [(1, 0, "system", "rules", "x", 1)]
    rows += [(1, n, ("ann", "bob")[n % 2] if n < 1000 else "bob" if n < 2000 else late[n % 3], f"t{n}", "x", 1) for n in range(1, 3000)]
    rows += [(1, None, "eve", "when?", "x", 1), (1, 10**12, "bob", "late", "x", 1)]
    got = whole(spark, rows)
    assert got == plain_whole(rows, 1024)
    assert {(r[1], r[2]) for r in got} == {(p, s) for p in range(3) for s in ("ann", "bob", "eve")}


def test_parts_are_bounded_in_messages(spark):
    """One dialogue of null turns, one of a single turn, beside short ones and repeated rows."""
    rows = [(7, None, f"s{n % 3}", f"null {n}", "x", 1) for n in range(500)]
    rows += [(8, 4, f"s{n % 2}", "same start " * 30 + str(n), "x", 1) for n in range(500)]
    rows += [(9, n, "ab"[n % 2], "again", "x", copy) for n in range(3) for copy in range(20)] + ROWS
    for size in (1, 10, 64):
        assert whole(spark, rows, size) == plain_whole(rows, size)
    assert max(r[5] for r in whole(spark, rows, 64)) == 64


def test_rows_of_every_kind(spark):
    got = chat.rotate_dialogues(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert {tuple(r) for r in got} == plain_whole(ROWS, 1024)
    for r in got:
        said = [r["rendered"][int(a) : int(b)] for a, b in (s.split("-") for s in r["mask"].split(","))]
        assert all(s.endswith("<|end|>") for s in said)


def test_query_equals_sql_beyond_one_part(spark, tmp_path):
    """3000 turns, ann silent after 1000, beside null and tied turns and rows of every kind."""
    rows = [(10, n, ("ann", "bob")[n % 2] if n < 1000 else "bob", f"turn {n}", "x", 1) for n in range(3000)]
    rows += [(11, None, f"s{n % 3}", f"null {n}", "x", 1) for n in range(1500)]
    rows += [(12, 4, "system" if n % 7 else "eve", f"tie {n}", "x", 1) for n in range(1100)] + ROWS
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op4_chat_formatting(spark, str(tmp_path))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
        found = con.sql(queries.ORACLES["op4_chat_formatting"])
        want = sorted(tuple(v) for v in found.project(", ".join(got.columns)).fetchall())
    blank = lambda rows: sorted((*r[:4], r[4] or "", *r[5:]) for r in rows)
    assert sorted(map(tuple, got.collect())) == want == blank(want)
    assert set(want) == plain_whole(rows, 1024)
    assert sum(r[2] == "ann" for r in want if r[0] == 10) == 3


def test_whole_dialogues_have_no_python(spark):
    rows = ROWS + [(5, n, "ab"[n % 2], str(n), "x", 1) for n in range(30)]
    for size in (10, 1024):
        df = chat.rotate_dialogues(spark.createDataFrame(rows, SCHEMA), part_messages=size)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert chat.rotate_dialogues(spark.createDataFrame([], SCHEMA)).count() == 0
