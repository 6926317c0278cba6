"""Operator 1: the compiler, reversible escapes, and rows against brute force and SQL."""

import hashlib
import random

import duckdb
import pytest

from pomelo.llm import chat_template as C
from pomelo.llm.common import prepare, table

SF = "/root/testdata/sf0.01"
MESSAGES = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": "yo"}, {"role": "user", "text": "a"}]


def out(template, messages=MESSAGES):
    return C.render(template, messages)[0]


def test_language():
    assert out("{% for m in messages %}{{ loop.index }}{{ m.role | upper }}:{{ m['text'] }}{% if not loop.last %}, {% endif %}{% endfor %}") \
        == "1USER:hi, 2ASSISTANT:yo, 3USER:a"
    assert out("{% set x = 'a' + 'b' %}{{ x }}{# gone #}{{ x | length }}") == "ab2"
    assert out("{% for m in messages %}{% if m.text == 'hi' %}1{% elif 'y' in m.text %}2{% else %}3{% endif %}{% endfor %}") == "123"
    assert out("{{ (1 == 1) and ('a' or none) }}{{ none }}{{ 'x\\n\\'' }}") == "ax\n'"
    assert C.render("{% for m in messages %}-{% generation %}{{ m.text }}{{ '!' }}{% endgeneration %}{% endfor %}", MESSAGES) \
        == ("-hi!-yo!-a!", [(1, 4), (5, 8), (9, 11)])


@pytest.mark.parametrize("bad", ["{% if 1 %}", "{% for in x %}{% endfor %}", "{{ }}", "{{ a b }}", "{% while %}", "{{ 'a' | nope }}",
                                 "{{ 1 + 'a' }}", "{{ f(1) }}", "{% generation %}", "{{ a + }}", "{{ $ }}"])
def test_errors_at_compile_time(bad):
    with pytest.raises(C.TemplateError):
        C.fold(C.parse(bad))


@pytest.mark.parametrize("bad", ["{{ messages.__class__ }}", "{{ nothing }}", "{{ 'a'.__class__ }}"])
def test_sandbox(bad):
    with pytest.raises(C.TemplateError):
        out(bad)


def test_constants_fold():
    tree = C.fold(C.parse("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}no{% else %}d{% endif %}{{ 1 }}{% if false and x %}{{ y }}{% endif %}"))
    assert tree == (C.Text("abCd1"),)
    assert C.fold(C.parse("{{ true and x }}")) == (C.Output(C.Name("x")),)


def test_escape_is_reversible_and_hides_controls():
    rng = random.Random(1)
    parts = ["\\", "<turn>", "</turn>", "<text>", "<", "turn>", "\n", "a", "/", "é", "</turn>\n<turn>"]
    for _ in range(3000):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4)]
        messages = [{"role": texts[0], "text": texts[1]}, {"role": "assistant", "text": texts[2]}, {"role": "x", "text": texts[3]}]
        assert all(C.unescape(C.escape(t)) == t for t in texts)
        formatted, spans = C.render(C.TEMPLATE, iter(messages))
        reader = C.Reader()
        back = [turn for piece in [formatted] for turn in reader.feed(piece)]
        reader.end()
        assert back == [(m["role"], m["text"]) for m in messages]
        loss = "".join(C.unescape(formatted[a:b]) for a, b in spans)
        assert loss == "".join(m["text"] for m in messages if m["role"] == "assistant")


def plain(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    want = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        size = sum(len(C.escape(r)) + len(C.escape(t)) + len("<turn><text></turn>\n") for *_, r, t in turns)
        want.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
    return sorted(want, key=repr)


def test_query_against_brute_force_and_sql(spark):
    from pomelo.llm.queries import ORACLES, QUERIES
    got = sorted(map(tuple, QUERIES["op1_chat_template"](spark, SF).collect()), key=repr)
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SF, "conversations").collect()]
    own = "\\### Assistant: </turn> ok"
    assert got == plain(rows + [(-7, 0, "user", own), (-7, 1, "assistant", own)])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    assert sorted(con.execute(ORACLES["op1_chat_template"]).fetchall(), key=repr) == got


def test_odd_rows(spark):
    prepare(spark)
    rows = [(1, 2, "assistant", None), (1, 1, "user", "x"), (1, 1, "user", "x"), (1, None, None, ""), (None, 1, "assistant", "</turn>"),
            (2, 1, "assistant", "z" * 300_000), (2, 1, "assistant", "a"), (3, 5, "tool", "\\")]
    df = spark.createDataFrame([(*r, "f") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    assert sorted(map(tuple, C.report(df).collect()), key=repr) == plain(rows)
    full = {r.conv_id: r for r in C.format_conversations(df).collect()}
    assert full[3].formatted == "<turn>tool<text>\\\\</turn>\n" and full[3].loss_spans == []
    assert [tuple(s) for s in full[None].loss_spans] == [(21, 29)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.report(df).count() == 0
    assert C.format_conversations(df).count() == 0
