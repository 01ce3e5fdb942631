import hashlib
import random

import pytest

from ledgerferry.llm import templates as T

COLUMNS = "conv_id long, turn long, role string, text string, piece string, loss int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    out, key = {}, lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        turns = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(x for role, x in turns if role == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


def digests(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in T.read_back(T.format_conversations(df)).collect()}


def test_turns_and_loss_come_back(spark):
    rng = random.Random(2)
    texts = ["", None, "a", "\\", "\\\\l", "<turn>", "</turn>\n", "\\### Assistant: </turn> ok", "x\ny\n", "é😀", "{{ t.role }}", "y" * 50_000, "\\" * 7]
    rows = [(c, rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", "system", None, "a\nb"]), rng.choice(texts)) for c in (None, -7, 0, 1, 2) for _ in range(40)]
    rows += [(5, 1, "assistant", "same")] * 3
    assert digests(frame(spark, rows)) == expected(rows)


def test_a_long_conversation_and_an_empty_table(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(6_000)] + [(2, 0, "user", "x")]
    assert digests(frame(spark, rows)) == expected(rows)
    assert digests(frame(spark, [])) == {}


def test_the_probe(spark):
    row = digests(T.with_probe(frame(spark, [])))[-7]
    said = r"\### Assistant: </turn> ok"
    assert row == (2, sha(f"user\n{said}\nassistant\n{said}\n"), len(said), sha(said))


@pytest.mark.parametrize(
    ("source", "turns", "output"),
    [
        ("{{ 'a' ~ 1 ~ (2 == 2) }}", [], "a1true"),
        ("{% if 'a' == 'b' %}x{% elif not false %}y{% else %}z{% endif %}", [], "y"),
        ("{% for t in turns %}{% if loop.first %}[{% endif %}{{ t.role|upper }}:{{ t.text|trim }};{% endfor %}]", [{"role": "u", "text": " q "}, {"role": "v"}], "[U:q;V:;]"),
        ("{% for t in turns %}{{ t.nothing.deeper }}{{ missing or 'd' }}{% endfor %}", [{"role": "u"}], "d"),
        ('{{ "q\\n" }}{% if 1 and 0 %}x{% endif %}', [], "q\n"),
    ],
)
def test_language(source, turns, output):
    assert "".join(x for x, _ in T.compile_template(source)(turns)) == output


def test_marks_follow_generation_blocks_and_constants_fold():
    render = T.compile_template("a{% generation %}b{{ 'c' }}{% endgeneration %}d")
    assert list(render([])) == [("a", False), ("bc", True), ("d", False)]
    assert T.fold_block(T.parse("{% if 1 == 1 %}x{{ 'y' ~ 'z' }}{% endif %}w")) == [("out", ("const", "xyzw"))]


@pytest.mark.parametrize("bad", ["{{ t.__class__|exec }}", "{% for x in y %}{% endfor %}", "{% if a %}", "{{ a( }}", "{% import os %}", "{{ 1 + 1 }}", "{% endfor %}"])
def test_what_is_not_of_the_language_is_refused(bad):
    with pytest.raises(T.TemplateError):
        T.compile_template(bad)


def test_attributes_never_reach_python_objects():
    assert "".join(x for x, _ in T.compile_template("{% for t in turns %}{{ t.text.__class__ }}{{ t.keys }}{% endfor %}")([{"text": "x"}])) == ""


def test_pieces_of_any_size_are_read_alike():
    whole = [(x, m) for x, m in T.compile_template(T.CHAT)([{"role": "assistant", "text": "a\\<b\nc"}, {"role": "user", "text": "\\"}])]
    one = T.Reader()
    for x, m in whole:
        one.feed(x, m)
    many = T.Reader()
    for x, m in whole:
        for c in x:
            many.feed(c, m)
    assert one.result()[:4] == many.result()[:4]
