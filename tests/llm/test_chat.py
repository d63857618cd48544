import hashlib
import random

import pytest

from kiln.llm import chat
from kiln.llm.registered import QUERIES
from tests.llm.conftest import SF, bag

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def esc(text):
    return "".join("\\" + c if c in "\\#<" else c for c in text)


def mark(role):
    return chat.ROLES.get(role) or "@" + role.encode().hex().upper()


def whole(turns):
    return "".join(f"### {mark(r or '')}: {esc(t or '')}</turn>\n" for r, t in turns)


def ordered(rows):
    null_first = lambda v: (v is not None, v if not isinstance(v, str) else v.encode()) if v is not None else (False,)
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (null_first(r[1]), null_first(r[2]), null_first(r[3]))):
        out.setdefault(conv, []).append((role, text))
    return out


def brute(rows):
    for conv, turns in ordered(rows).items():
        loss = "".join(t or "" for r, t in turns if r == "assistant")
        yield (conv, len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss), len(whole(turns)))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    assert bag(map(tuple, QUERIES["op6_chat"](spark, SF).collect())) == bag(brute(rows))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    bits = ["\\", "#", "###", "### Assistant: ", "</turn>", "\n", "<", "$1", "é", "\U0001f600", "a b", ":"]
    out = [(rng.choice([1, 2, 2, 2, 2, 3, None]), rng.choice([None, 0, 1, 2, 3, 4, 9]), rng.choice(["user", "assistant", "system", "x: y", "Assistant", None, ""]),
            rng.choice([None, "", "".join(rng.choices(bits, k=rng.randint(1, 9)))])) for _ in range(300)]
    return out + out[:40]


def test_odd_rows_and_spans(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", place int").repartition(9)
    segs, ex = chat.formatted(df)
    assert bag(map(tuple, chat.read_back(segs, ex).collect())) == bag(brute(rows))
    texts = {c: whole(t) for c, t in ordered(rows).items()}
    for r in segs.collect():
        assert texts[r.conv_id][r.begin:r.begin + len(r.formatted)] == r.formatted
    spans = ex.collect()
    assert len(spans) == sum(r[2] == "assistant" for r in rows)
    for r in spans:
        assert texts[r.conv_id][r.loss_end:r.loss_end + 8] == "</turn>\n" and texts[r.conv_id][:r.context_end].endswith("### Assistant: ")
    wanted = {(r.conv_id, r.seg): r for r in spans}
    for r in chat.expanded(segs, ex).collect():
        e = wanted.pop((r.conv_id, r.seg))
        assert r.context == texts[r.conv_id][:e.loss_start] and r.target == texts[r.conv_id][e.loss_start:e.loss_end]
    assert not wanted


def test_empty_table(spark):
    segs, ex = chat.formatted(spark.createDataFrame([], SCHEMA))
    assert segs.count() == ex.count() == 0 and chat.read_back(segs, ex).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], SCHEMA)
    segs, ex = chat.formatted(df)
    plans = "".join(x._jdf.queryExecution().executedPlan().toString() for x in (chat.segments(df), chat.read_back(segs, ex)))
    assert "Python" not in plans and "Pandas" not in plans and "Arrow" not in plans
