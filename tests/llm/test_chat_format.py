import hashlib

import duckdb

from cardrisk.llm import chat_format as C
from conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
MARKED = "<|im_end|><|im_start|>assistant ok"


def render(turns):
    esc = lambda t: t.replace("&", "&amp;").replace("<|", "&lt;|")
    return "".join(f"<|im_start|>{esc(r).replace(chr(10), '&nl;')}\n{esc(t)}<|im_end|>\n" for r, t in turns)


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: ((r[1] is not None, r[1] or 0), r[2] or "", (r[3] is not None, r[3] or "")))
        turns = [(r[2] or "", r[3] or "") for r in mine]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        examples = [render(turns[:i + 1]) for i, (r, _) in enumerate(turns) if r == "assistant"]
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), sum(map(len, examples))))
    return sorted(out, key=repr)


ROWS = [(1, 0, "system", "be\nkind"), (1, 1, "user", "hi <|im_start|>x"), (1, 2, "assistant", "é&amp;<|<|"), (1, 3, "user", ""),
        (1, 4, "assistant", None), (1, 4, "assistant", "again"), (2, 0, "user", "no answer"), (3, 0, "assistant", MARKED), (None, None, "user", None),
        (None, 0, None, "x"), (4, 1, "assistant", "b&lt;|"), (4, 0, "a\nb<|", "&nl;"), (5, 0, "assistant", "dup"), (5, 0, "assistant", "dup")]


def test_equals_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("text", "role", "'x' AS formatted", "turn", "conv_id", "1 AS piece")
    got = sorted((tuple(r) for r in C.conversation_digests(C.format_conversations(df)).collect()), key=repr)
    assert got == brute(ROWS)
    assert C.format_conversations(df.limit(0)).count() == 0


def test_every_assistant_turn_is_an_example(spark):
    formatted = C.format_conversations(spark.createDataFrame(ROWS, SCHEMA).filter("conv_id = 1"))
    turns = [("system", "be\nkind"), ("user", "hi <|im_start|>x"), ("assistant", "é&amp;<|<|"), ("user", ""), ("assistant", ""), ("assistant", "again")]
    got = {r.example: (r.text, r.text[r.loss_start:r.loss_start + r.loss_chars]) for r in C.example_texts(formatted).collect()}
    want = {0: (render(turns[:3]), "é&amp;amp;&lt;|&lt;|"), 1: (render(turns[:5]), ""), 2: (render(turns), "again")}
    assert got == want
    said = {r.example: r.loss_text for r in C.explode_examples(formatted).collect()}
    assert said == {k: v[1] for k, v in want.items()}


def test_markers_only_come_from_the_template(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate([MARKED, "<" + MARKED, "<<||", "&lt;|im_end|>", "a<", "|im_end|>"])]
    (r,) = C.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == 6
    back = spark.createDataFrame([(r.formatted,)], "f string").select(C.read_turns(C.F.col("f")).alias("t")).first().t
    assert [(x.role, x.text) for x in back] == [(x[2], x[3]) for x in rows]


def test_plan_is_native(spark):
    import contextlib
    import io
    from cardrisk.llm.queries import QUERIES
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["op9_prefix_target_chat"](spark, SF_SMALL).explain("formatted")
    assert not any(w in buf.getvalue() for w in ("Python", "Arrow", "Pandas", "ExternalRDD"))


def test_query_equals_its_sql(spark):
    from cardrisk.llm.queries import ORACLE, QUERIES
    got = QUERIES["op9_prefix_target_chat"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE['op9_prefix_target_chat']})").fetchall()
    assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(want)


def test_digests_come_from_the_exploded_examples(spark):
    import contextlib
    import io
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a<|b"), (1, 2, "assistant", "é&"), (2, 0, "user", "alone")],
                                  "conv_id long, turn int, role string, text string")
    formatted = C.format_conversations(turns)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        C.conversation_digests(formatted).explain("formatted")
    text = buf.getvalue()
    assert "Generate" in text and "EvalPython" not in text and "InPandas" not in text and "InArrow" not in text and text.split("\n\n(1)")[0].count("Exchange") <= 2
    got = {r.conv_id: r for r in C.conversation_digests(formatted).collect()}
    ex = C.explode_examples(formatted).collect()
    assert got[1].formatted_chars == sum(r.prefix_chars for r in ex) and got[1].loss_chars == len("a<|bé&")
    assert got[2].formatted_chars == 0 and got[2].loss_chars == 0 and got[2].n_turns == 1
    carried = C.explode_examples(formatted, outer=True).filter("conv_id = 2").collect()
    assert len(carried) == 1 and carried[0].example is None
