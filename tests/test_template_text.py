import pytest
from pyspark.sql import functions as F

from turnloom.jobs import main
from turnloom.operators.templates import TEMPLATES, render_chat

CHAT = [("system", " s "), ("user", "q"), ("assistant", " r\n")]
SCHEMA = "id int, messages array<struct<role:string,content:string>>"


@pytest.fixture(scope="module")
def shown(spark):
    def text(template, *chats):
        rows = spark.createDataFrame(list(enumerate(chats or (CHAT,))), SCHEMA)
        found = rows.select("id", render_chat(F.col("messages"), template).alias("t")).orderBy("id").collect()
        return found[0].t if len(found) == 1 else [r.t for r in found]

    return text


@pytest.mark.parametrize(
    "template, text",
    [
        ("{{ messages[0].content|trim }}", "s"),
        ("{% for m in messages %}{{ m['role'][0:] if false else loop.index }},{% endfor %}", None),
        ("{% for m in messages %}{{ loop.index ~ m.role }}{{ ',' if not loop.last }}{% endfor %}", "1system,2user,3assistant"),
        ("{% for m in messages[1:] %}<{{ m.content.strip() }}>{% endfor %}", "<q><r>"),
        ("{% for m in messages %}\n  {% if m.role == 'user' %}\nU\n  {% elif loop.first %}\nF\n  {% else %}\nE\n  {% endif %}\n{% endfor %}", "F\nU\nE\n"),
        ("  {%- if messages | length > 2 -%}\n yes {%- endif %}\nend", "yesend"),
        ("{# no {{ value }} #}\na\n{{ 'b\\'\"' }}\n", "a\nb'\"\n"),
        ("{% set a = 'x' %}{% if messages[0].role != 'user' %}{% set a = a + 'y' %}{% endif %}{{ a }}", "xy"),
        ("{% for m in messages %}{% set a = m.role %}{% endfor %}{{ a is defined }}", "False"),
        ("{{ messages[-1].role }}{{ messages[0].name is defined }}{{ 1 + 2 }}{{ not add_generation_prompt }}", "assistantFalse3True"),
        ("{% for m in messages %}{{ (m.role == 'user') == (loop.index0 % 2 == 1) }} {% endfor %}", "True True True "),
        ("{% for m in messages %}{% for n in messages %}{{ loop.index }}{% endfor %}{{ loop.index0 }}{% endfor %}", "123012311232"),
        ("{{ bos_token }}{{ 'us' in messages[1].role and 'x' not in 'y' }}", "True"),
    ],
)
def test_values_and_tags(shown, template, text):
    if text is None:
        with pytest.raises(ValueError, match="not supported"):
            shown(template)
    else:
        assert shown(template) == text


@pytest.mark.parametrize(
    "template",
    [
        "{% macro m() %}{% endmacro %}", "{% for m in tools %}{% endfor %}", "{{ messages|tojson }}",
        "{{ strftime_now('%d') }}", "{% if messages %}", "{{ messages }}", "{% endif %}", "{{ 'a' }} {% if",
        "{{ 'a' * 3 }}", "{{ __import__('os') }}", "{{ loop.depth }}{% for m in messages %}{{ loop.depth }}{% endfor %}",
    ],
)
def test_what_is_not_understood_is_refused(shown, template):
    with pytest.raises(ValueError, match="chat template"):
        shown(template)


def test_nulls_empty_lists_and_stops(shown):
    template = "{% for m in messages %}[{{ m.role }}:{{ m.content }}]{% endfor %}."
    assert shown(template, [(None, None), ("user", "")], [], None) == ["[:][user:].", ".", None]
    stop = "{% if messages[0].role == 'user' %}ok{% else %}{{ raise_exception('starts with ' + messages[0].role) }}{% endif %}"
    assert shown(stop, CHAT[1:]) == "ok"
    with pytest.raises(Exception, match="starts with system"):
        shown(stop)


def test_built_in_formats_are_texts(shown):
    assert all(isinstance(t, str) for t in TEMPLATES.values())
    assert shown("gemma-3", [("system", "s")]) == "<bos>"
    assert shown("qwen", []) == ""


def test_the_job_takes_a_template_text(spark, folder):
    path, out = f"{folder}/chats", f"{folder}/ready"
    rows = spark.createDataFrame([(0, CHAT)], SCHEMA)
    rows.write.json(path)
    own = "{% for m in messages %}{{ m.role }}={{ m.content | trim }};{% endfor %}"
    main(["prepare", f"--train={path}", f"--output={out}", "--use_chat_template=1", f"--template={own}"])
    assert spark.read.json(f"{out}/train").first().text == "system=s;user=q;assistant=r;"
