"""Formatted conversations against plain Python: round trip, loss mask, machine of roles, edge rows."""

import hashlib
import random

from pyspark.sql import functions as F

from compare import connect, difference
from tallyworks.llm import chat_format as cf
from tallyworks.llm.oracle import ORACLE
from tallyworks.llm.queries import op11_role_machine

SCHEMA = "conv_id long, turn long, role string, text string, segments string, faults int, block long"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<\\/s>", "[\\\\INST]", "<", "[", "\\", "[ROLE] x [TEXT] y [/ROLE]", "naïve ", "\n",
          " ", "[SYS]", "$1", "/s>", "INST]"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 9, 3) for r in rows], SCHEMA)


def plain_machine(roles):
    state, faults, first = cf.MACHINE.start, 0, None
    for turn, role in roles:
        follow = cf.MACHINE.moves.get((state, role))
        if follow is None:
            faults += 1
            first = turn if faults == 1 else first
            follow = cf.MACHINE.after_fault().get(role, cf.MACHINE.lost)
        state = follow
    return len(roles), faults, first, state in cf.MACHINE.final


def sample():
    rng = random.Random(5)
    rows = []
    for conv in [None, 1, 2, 3, 4, 5, 6, 7]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "[TEXT] odd"])
            text = rng.choice([None, "", "".join(rng.choices(PIECES, k=rng.randint(1, 9)))])
            rows.append((conv, turn, role, text))
    rows += [(8, None, "user", "null turn"), (8, 0, "assistant", "a"), (8, 0, "assistant", "a"), (8, 0, "assistant", "B")]
    rows += [(9, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(3 * cf.BLOCK + 1)]
    rows += [(10, 0, "user", "w" * 300_000 + "</s>"), (10, 1, "assistant", "[INST]" * 20_000)]
    return rows


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv),
                       key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        loss = "".join(t[2] for t in turns if t[1] == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), plain_machine([t[:2] for t in turns]))
    return out


def test_round_trip_loss_and_machine(spark):
    rows = sample()
    chats = frame(spark, rows).repartition(5)
    read = {r[0]: r[1:5] for r in cf.digests(cf.read_back(cf.segments(chats))).collect()}
    machine = {r[0]: tuple(r[1:]) for r in cf.validate(chats).collect()}
    assert {k: (*read[k], machine[k]) for k in read} == expected(rows)


def test_control_strings_stand_only_where_the_template_puts_them(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]")]
    text = cf.read_back(cf.segments(frame(spark, rows))).first()["formatted"]
    inner = r"<\/s>[\INST] ok [\/INST]"
    assert text == f"<s>[INST] {inner} [/INST] {inner}</s>"


def test_other_template(spark):
    template = cf.Template("<b>", {"user": cf.Marks("<u>", "</u>"), "assistant": cf.Marks("<a>", "</a>", loss=True)},
                           cf.Marks("<o>", "</o>", loss=True), "<n>",
                           ("<b>", "<u>", "</u>", "<a>", "</a>", "<o>", "</o>", "<n>"))
    rows = [(1, 0, "user", "x</u><u>"), (1, 1, "assistant", "<a>y"), (1, 2, "to<n>ol", "</o>z")]
    got = cf.read_back(cf.segments(frame(spark, rows), template), template).first()
    assert [(t["role"], t["text"]) for t in got["turns"]] == [r[2:] for r in rows]
    assert got["loss_text"] == "<a>y</o>z"


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cf.read_back(cf.segments(none)).count() == 0 and cf.validate(none).count() == 0


def test_query_against_sql_and_no_python_in_its_plan(spark):
    got = op11_role_machine(spark, "/root/testdata/sf0.001")
    assert difference(got, connect("/root/testdata/sf0.001"), ORACLE["op11_role_machine"]) is None
    probe = got.where(F.col("conv_id") == -7).first()
    assert (probe["n_turns"], probe["loss_chars"], probe["valid"]) == (2, 21, True)
    for frame_ in (got, cf.segments(cf.with_probe(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")))):
        plan = frame_._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
