from flowframe.llm.chat import CLOSE, OPEN, rotate

SCHEMA = "conv_id long, turn long, role string, text string, perspective string"


def render(rows, speaker):
    """One part's text and spans, the plain way."""
    text, spans = "", []
    for _, role, words in sorted(rows, key=lambda r: (r[0], r[1] or "", r[2] or "")):
        name = "assistant" if role == speaker else "system" if role == "system" else f"user name={role}" if role else "user"
        text += f"{OPEN}{name}\n"
        start = len(text)
        text += (words or "") + CLOSE
        if role == speaker:
            spans.append((start, len(text)))
    return text, spans


def rotated(spark, rows, **options):
    out = rotate(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return {(r.conv_id, r.perspective, r.part): (r.text, [tuple(s) for s in r.mask], r.n_turns) for r in out}


def test_each_speaker_has_a_view(spark):
    rows = [(0, "system", "Be brief."), (1, "ann", "Hi"), (2, "bob", "Hé!"), (3, "cem", ""), (4, "ann", "Bye")]
    got = rotated(spark, [(1, *r, "clash") for r in rows])
    assert set(got) == {(1, s, 0) for s in ("ann", "bob", "cem")}
    for (_, speaker, _), (text, spans, n) in got.items():
        assert (text, spans) == render(rows, speaker) and n == 5
        assert all(text[a:b].endswith(CLOSE) for a, b in spans)


def test_nulls_ties_and_repeated_turns(spark):
    rows = [(0, "ann", "x"), (0, "ann", "x"), (0, None, None), (0, "", "y"), (1, "bob", None)]
    got = rotated(spark, [(None, *r, None) for r in rows])
    assert {k[1] for k in got} == {"ann", "bob"} and {k[0] for k in got} == {None}
    assert got[None, "ann", 0][2] == 5
    assert len(got[None, "ann", 0][1]) == 2 and len(got[None, "bob", 0][1]) == 1


def test_parts_and_turns_without_number(spark):
    rows = [(t, "ann" if t % 2 else "bob", f"w{t}") for t in range(10)]
    got = rotated(spark, [(7, *r, "") for r in rows] + [(7, None, "ann", "late", "")], turns_per_part=4)
    assert {k[2] for k in got} == {0, 1, 2, None}
    assert sum(v[2] for k, v in got.items() if k[1] == "ann") == 11
    for part in range(3):
        assert got[7, "bob", part][:2] == render([r for r in rows if r[0] // 4 == part], "bob")


def test_only_system_turns_and_empty_tables(spark):
    assert rotated(spark, [(1, 0, "system", "x", "")]) == {}
    assert rotated(spark, []) == {}


def test_very_long_turn(spark):
    got = rotated(spark, [(1, 0, "ann", "ab " * 300_000, ""), (1, 1, "bob", "ok", "")])
    text, spans, _ = got[1, "ann", 0]
    assert spans == [(len(OPEN) + 10, len(OPEN) + 10 + 900_000 + len(CLOSE))] and len(text) > 900_000
