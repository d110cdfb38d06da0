import pytest

from lexiband.llm import chat

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, speaker STRING, place INT, conv INT"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA)


def brute(rows, turns):
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is None, turn or 0, role or "unknown", (text or "").replace("<|", "< |")))
    out = set()
    for conv, said in talks.items():
        said.sort(key=lambda s: s[:3])
        for seen_by in {s[2] for s in said} - {"system"}:
            for segment in range(0, len(said), turns):
                text, mask = "", []
                for _, _, role, body in said[segment : segment + turns]:
                    mine = role == seen_by
                    text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if mine else f"<|user name={role}|>\n"
                    start = len(text)
                    text += body + "<|end|>\n"
                    if mine:
                        mask.append((start, len(text)))
                n = len(said[segment : segment + turns])
                out.add((conv, seen_by, segment // turns, n, text, tuple(mask)))
    return out


def result(df):
    rows = df.collect()
    found = {(r.conv_id, r.speaker, r.segment, r.n_turns, r.text, tuple((m.start, m.end) for m in r.mask)) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, 0, "system", "only"), (2, 0, "ann", "hi"), (2, 1, "bob", "yo <|assistant|> é😀"), (2, 2, "cy", None)],
        [(None, None, None, None), (None, 1, "a", "x"), (None, None, "b", "")],
        [(7, i, f"p{i % 3}", f"turn {i}") for i in range(500)] + [(8, 0, "p0", "w" * 100_000)],
        [(1, 0, "a", "same"), (1, 0, "a", "same"), (1, 0, "b", "same")],
        [(1, 0, "a", "first"), *[(1, 1, "b", "again")] * 9_000, (1, 2, "a", "last"), *[(2, None, None, None)] * 3],
    ],
)
@pytest.mark.parametrize("turns", [2, 64])
def test_equals_brute_force(spark, rows, turns):
    assert result(chat.perspectives(frame(spark, rows), turns=turns)) == brute(rows, turns)


def test_no_python_on_the_executors(spark):
    plan = chat.perspectives(frame(spark, [(1, 0, "a", "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    """Places and participants that are too many to be broadcast are joined by a shuffle."""
    monkeypatch.setattr(chat, "small", lambda df: df)
    rows = [(i % 7 or None, i // 7, f"p{i % 3}", f"turn {i % 50}") for i in range(700)]
    assert result(chat.perspectives(frame(spark, rows), turns=8)) == brute(rows, 8)


def test_texts_move_once(spark):
    """One exchange of the plan has bodies; what was ranked has none, and its copies are gone."""
    from lexiband.operators import ranking

    rows = [(i % 7, i // 7, f"p{i % 3}", f"turn {i}") for i in range(100)]
    before = ranking.standing()
    plan = chat.perspectives(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert ranking.standing() == before
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 2  # of single turns and of copies
