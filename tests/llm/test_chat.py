"""Operator 13: the template language, reversible escapes, and conversations read back."""

import hashlib
from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewpulse.llm import chat_format, queries
from viewpulse.llm.chat_format import INSTRUCT
from viewpulse.llm.chat_template import Branch, Escaper, Show, TemplateError, _Parser, compile_template, fold, OPERATORS, FILTERS

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROLS = list(INSTRUCT.controls)
BITS = ["[", "]", "<", ">", "\\", "/", "s", "s>", "INST]", "OUT", "a", " ", "\n", "é", "{{", "%}", "</s>", "[INST]", "[/INST]", "[\\INST]", "<\\\\/s>", "[IN"]
TRICKY = st.lists(st.sampled_from(BITS), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(TRICKY)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    e = Escaper(CONTROLS)
    assert e.unescape(e.escape(text)) == text
    assert not e.marks.search(e.escape(text))


def test_control_strings_that_could_overlap_are_refused():
    for bad in (["<"], ["a\\b"], ["<<SYS>>"], ["[A]", "<[>"]):
        with pytest.raises(TemplateError):
            Escaper(bad)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[TEXT]", "User"]), TRICKY), max_size=5))
def test_turns_come_back(messages):
    template, reader = INSTRUCT.template(), chat_format.Reader(INSTRUCT)
    text, spoken = template.before, []
    for role, own in messages:
        piece, spans = template.render_message(role, own)
        spoken += [piece[a:b] for a, b in spans]
        text += piece
    assert list(reader.turns(text + template.after)) == messages
    assert [reader.escaper.unescape(s) for s in spoken] == [t for r, t in messages if r == "assistant"]


LANGUAGE = """{{ head }}
{%- for m in messages -%}
{% set who = m.role | upper %}
{%- if who == 'USER' and not loop.first or m['text'] in ('a' ~ 'b') -%}<{{ who ~ ':' + m.text | trim }}>
{%- elif 1 + 1 == 3 -%}never
{%- else -%}{% generation %}{{ m.text if m.text != '' else none }}{% endgeneration %}{{ loop.index0 + loop.index }}{{ 'last' if loop.last }}
{%- endif -%}
{%- endfor %}{{ "\\n" + 'end' | capitalize }}"""


def test_language():
    t = compile_template(LANGUAGE, {"head": "H"})
    assert (t.before, t.after, t.loop_fields) == ("H", "\nEnd", {"first", "index", "index0", "last"})
    loop = {"first": False, "index": 3, "index0": 2, "last": True}
    assert t.render_message("user", " x ", loop) == ("<USER:x>", [])
    assert t.render_message("bot", "hello", loop) == ("hello5last", [(0, 5)])
    assert t.render_message("bot", "ab", loop) == ("<BOT:ab>", [])
    assert t.render_message("user", "", loop | {"first": True}) == ("<USER:>", [])  # '' is in every string


def test_folding():
    source = "{% for m in messages %}{% if yes %}a{{ 'b' ~ 1 }}{% else %}c{% endif %}{% if m.role == 'x' %}1{% elif yes %}2{% else %}3{% endif %}{% endfor %}"
    functions = OPERATORS | {"|" + n: f for n, f in FILTERS.items()}
    (each,) = fold(_Parser(source, {"yes": True}, FILTERS).body()[0], functions)
    assert [type(n) for n in each.body] == [Show, Branch] and each.body[0].expression.value == "ab1"
    assert len(each.body[1].cases) == 2


@pytest.mark.parametrize("bad", [
    "no loop", "{% for m in messages %}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{{ x }}{% for m in messages %}{% endfor %}",
    "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ m }}{% endfor %}", "{% for m in messages %}{{ loop.depth }}{% endfor %}",
    "{% for m in messages %}{{ m.text() }}{% endfor %}", "{% for m in messages %}{{ m.text | eval }}{% endfor %}", "{% for m in messages %}{{ y }}{% endfor %}",
    "{% include 'a' %}{% for m in messages %}{% endfor %}", "{% for m in range(9) %}{% endfor %}", "{% for m in messages %}{{ m.text %}{% endfor %}",
    "{% for m in messages %}{% endfor %}{{ m.text }}", "{% for m in messages %}{% if m.role %}{% endfor %}", "{% for m in messages %}{{ 'a }}{% endfor %}", "{{"])
def test_what_the_language_refuses(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    e, convs = Escaper(CONTROLS), {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        convs.setdefault(conv, []).append((role or "", text or ""))
    around = {"assistant": ("[OUT]", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]")}
    out = []
    for conv, turns in convs.items():
        spoken = "".join(t for r, t in turns if r == "assistant")
        whole = "<s>" + "".join("".join(around[r]) + e.escape(t) if r in around else f"[ROLE]{e.escape(r)}[TEXT]{e.escape(t)}[/ROLE]" for r, t in turns)
        out.append((conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(spoken), digest(spoken), len(whole)))
    return out


ROWS = [(1, 1, "assistant", "b </s> [\\INST]"), (1, 0, "user", "a [INST]"), (2, 0, None, None), (None, 0, "user", "no id"), (None, 1, "assistant", "é\U0001f600"),
        (3, 0, "tool", "[TEXT]"), (3, None, "system", ""), (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "assistant", "x" * 300_000), (5, 1, "assistant", ""),
        *[(6, i, ("user", "assistant")[i % 2], f"turn {i} <s>") for i in range(500)]]


@pytest.mark.parametrize("part_chars", [1_000_000, 200])
def test_conversations_come_back(spark, part_chars):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("piece", F.lit("clash")).withColumn("spans", F.lit("clash")).repartition(6)
    parts = chat_format.format_conversations(df, part_chars=part_chars)
    direct = chat_format.read_back(parts, arranged=True).collect()
    stored = chat_format.read_back(parts.repartition(3)).collect()
    order = lambda rows: sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0))
    assert order(direct) == order(stored) == order(brute(ROWS))
    if part_chars == 200:  # whole messages, and no part much longer than asked for
        assert parts.where("conv_id = 6").agg(F.max(F.length("text"))).first()[0] <= 240
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0)), arranged=True).collect() == []


def test_templates_that_look_at_the_loop(spark):
    chat = replace(INSTRUCT, source="{% for m in messages %}{{ loop.index }}/{{ m.text }}{{ '' if loop.last else ',' }}{% endfor %}.")
    df = spark.createDataFrame([(1, 5, "user", "b"), (1, 2, "user", "a"), (2, 0, "user", "c")], SCHEMA)
    assert sorted((r.conv_id, r.text) for r in chat_format.format_conversations(df, chat).collect()) == [(1, "1/a,2/b."), (2, "1/c.")]


def test_registered_query(spark):
    got = queries.op13_chat_format(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert sorted(map(tuple, got.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect())) == sorted(brute(rows))
