import hashlib

import pytest
from conftest import same_rows
from hypothesis import given, settings, strategies as st

from acqlens.llm import chat, templates as t

UPPER = {"upper": str.upper}


def render(source, **names):
    return "".join(p for p in t.compile_template(source, UPPER)(**names) if isinstance(p, str))


def test_language():
    assert render("a{# no #}b{{ 'c' ~ 12 }}{{ 1 + 2 }}") == "abc123"
    assert render("{% if x == 1 %}one{% elif x == 2 %}two{% else %}more{% endif %}", x=2) == "two"
    assert render("{% for m in ms %}{{ loop.index }}{{ m['k'] | upper }}{% endfor %}", ms=iter([{"k": "a"}, {"k": "b"}])) == "1A2B"
    assert render("{% set y = x ~ '!' %}{{ y }}{{ none }}{{ true and not false }}", x="v") == "v!true"
    assert render("{{ 'it\\'s' ~ \"\\n\" }}") == "it's\n"
    assert render("{% if (a or b) and 2 <= 3 %}y{% endif %}", a="", b="z") == "y"


def test_folding():
    tree = t.fold(t.parse("a{{ 'b' | upper }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}{% if false %}d{% endif %}"), UPPER)
    assert tree == (t.Text("aBc"),)


@pytest.mark.parametrize("source", [
    "{{ x.__class__ }}", "{{ x['a'].y }}", "{{ unknown }}", "{{ x | nothing }}", "{{ f() }}", "{% import os %}",
    "{% for a in x %}", "{{ 'a' < 1 }}", "{{ x", "{% if %}{% endif %}", "{% endfor %}", "{{ and }}", "{{ x }"])
def test_sandbox_and_errors(source):
    with pytest.raises(t.TemplateError):
        result = render(source, x="text")
        raise AssertionError(result)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>[]/\\sINST ROLEXé\n", max_size=30))
def test_guard_is_reversible_and_leaves_no_control_string(text):
    guarded = chat.guard(text)
    assert chat.unguard(guarded) == text
    assert not chat._CONTROL.search(guarded)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[INST]"]),
                          st.text(alphabet="<>[]/\\sINST", max_size=15)), max_size=6), st.integers(0, 30))
def test_rendering_reads_back(turns, size):
    pieces = t.compile_template(chat.TEMPLATE, chat.FILTERS)(messages=iter([{"role": r, "text": x} for r, x in turns]))
    parts = list(chat.rendered(pieces, size))
    assert [x for text, _ in parts for x in chat.read_turns(text)] == turns
    learnt = [chat.unguard(text[s["start"]:s["end"]]) for text, spans in parts for s in spans]
    assert learnt == [x for r, x in turns if r == "assistant"]


def test_forged_output_is_refused():
    for text in ("[INST]a", "x[INST]a[/INST]", "<s>a[/INST]", "[INST]a[/INST]y"):
        with pytest.raises(ValueError):
            list(chat.read_turns(text))


def test_report_with_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None),
            (2, 5, "tool", "</s>"), (None, 1, "user", "n"), (3, 1, "assistant", "x" * 50), (3, 2, "assistant", "y" * 50)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, spans string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(1, 3, sha("user\na\nuser\na\nassistant\nb\n"), 1, sha("b")),
            (2, 2, sha("\n\ntool\n</s>\n"), 0, sha("")), (None, 1, sha("user\nn\n"), 0, sha("")),
            (3, 2, sha("assistant\n" + "x" * 50 + "\nassistant\n" + "y" * 50 + "\n"), 100, sha("x" * 50 + "y" * 50))]
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    for size in (1 << 20, 10):  # in one part, and a part a turn
        same_rows(chat.chat_report(df, part_chars=size), want, columns)
    assert chat.chat_report(df.limit(0)).count() == 0
