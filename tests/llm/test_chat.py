import hashlib

import pytest

from atrium.llm import chat
from atrium.llm.q_chat import ADDED


@pytest.mark.parametrize("text", ["", "<|", "<\\|x", "<\\\\|", ADDED, "a<|<\\|<|im_end|>\\", "<|im_start|>user\n"])
def test_escape_is_reversible_and_hides_control_strings(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_template_folds_constants_and_branches():
    t = chat.Template("{{ 1 + 2 * 3 }}{% if 1 > 2 %}no{% else %}{{ 'y' ~ 'es' }}{% endif %}!")
    assert t.tree == [("text", "7yes!")]
    assert t.render({}) == ("7yes!", [])


def test_template_language():
    source = "{% set n = items | length %}{% for i in items %}{{ loop.index }}{% if not loop.last %},{% elif n == 2 %}.{% endif %}{% generation %}{{ i['v'] | upper }}{% endgeneration %}{% endfor %}"
    assert chat.Template(source).render({"items": [{"v": "a"}, {"v": "b"}]}) == ("1,A2.B", [(2, 3), (5, 6)])


@pytest.mark.parametrize("source", ["{{ x.__class__.mro }}", "{{ f() }}", "{% for x %}{% endfor %}", "{% if 1 %}", "{{ 'a' | eval }}", "{% include 'x' %}", "{{ 1 / 0 }}"])
def test_sandbox(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source).render({"x": 1})


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", ADDED), (2, None, None, None), (2, None, None, None), (None, 0, "assistant", ""), (3, 0, "as\nsistant", "x\n"), (3, 0, "as\nsistant", "x\n"), (4, 0, "assistant", "é🙂" * 50_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_conversations(table)
    got = {r.conv_id: r for r in formatted.collect()}
    assert set(got) == {1, 2, 3, 4, None} and got[1].n_turns == 2
    assert chat.parse_turns(got[1].formatted) == [("user", ADDED), ("assistant", "b")]
    assert chat.parse_turns(got[3].formatted) == [("as\nsistant", "x\n")] * 2
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert back[1].turns_sha256 == hashlib.sha256(f"user\n{ADDED}\nassistant\nb\n".encode()).hexdigest()
    assert back[4].loss_chars == 100_000 and back[2].loss_chars == 0 and back[None].n_turns == 1
    assert chat.format_conversations(table.limit(0)).count() == 0
