"""Golden cases for the model-answer parser (ANN5-ANN7) and prompt (ANN1)."""

import pytest

from quarry.functions.response import PROMPT_BODY, PROMPT_HEAD, parse_response, prompt_text

NL = "\n"
GOLDEN = [
    ("Summary: A b." + NL + "Relevant: maybe - x" + NL + NL + "Details: one." + NL + " two." + NL
     + "Relevant agencies act.", "A b.", "Maybe", "one. two. agencies act."),
    ("1. Summary: X" + NL + "2. Relevant: Yes" + NL + "3. Because.", "X", "Yes", "3. Because."),
    ("Summary: X" + NL + "Relevant: No" + NL + "Details: y", "X", "No", ""),
    ("Just a sentence." + NL + "Yes" + NL + "more", "Just a sentence.", "Yes", "more"),
    ("Summary: first" + NL + "Summary: second" + NL + "Relevance: Yes", "second", "Yes", ""),
    ("Relevant: unclear" + NL + "Summary: s", "s", "No", ""),
    ("Details: a" + NL + "Relevant: Yes", "", "Yes", "a Yes"),
    ("**Summary:** x", "**Summary:** x", "No", ""),
    ("- Relevant: Yes", "Yes", "Yes", ""),
    ("", "", "No", ""),
    # extra cases
    ("SUMMARY : upper" + NL + "relevance:MAYBE" + NL + "details:  d1" + NL + "d2", ": upper", "Maybe", "d1 d2"),
    ("Summary: s" + NL + "Relevant: No, yes" + NL + "Details: hidden", "s", "No", ""),
    ("Intro line" + NL + "Relevant - Maybe" + NL + "Summary of things", "Intro line", "Maybe",
     "of things"),
    ("Summary: nbsp " + NL + "Relevant: Yes", "nbsp", "Yes", ""),
    ("Details:" + NL + "Relevant: Maybe", "", "Maybe", "Maybe"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id int, response string")
    return {r.id: r for r in parse_response(df).collect()}


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden(parsed, i):
    r = parsed[i]
    assert (r.description, r.relevant_eo, r.full_summary) == GOLDEN[i][1:]


def test_null_response(spark):
    df = spark.createDataFrame([(1, None)], "id int, response string")
    r = parse_response(df).first()
    assert (r.description, r.relevant_eo, r.full_summary) == ("", "No", "")


def test_prompt_scope_line(spark):
    df = spark.createDataFrame([("TEXT",)], "t string")
    with_topic = df.select(prompt_text("t", "  Immigration ").alias("p")).first().p
    without = df.select(prompt_text("t").alias("p")).first().p
    assert without == PROMPT_HEAD + PROMPT_BODY + "TEXT"
    assert "Relevance scope: Immigration. Mark 'Relevant' only if the action materially concerns " \
           "Immigration (not just tangential mentions).\n" in with_topic
    assert with_topic.endswith("Executive Action:\nTEXT")


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_word = st.text(alphabet="abcdefghijklmnopqrstuvwxyzéü ,.", min_size=1, max_size=20).map(str.strip).filter(
    lambda w: w and not w.lower().startswith(("summary", "relevan", "detail")))
_pad = st.sampled_from(["", " ", "\t", " "])
_case = st.tuples(_word, st.sampled_from(["Yes", "No", "Maybe", "yes", "MAYBE"]), _word, _pad, _pad,
                  st.booleans())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cases=st.lists(_case, min_size=1, max_size=25))
def test_labelled_answers_parse_to_their_parts(spark, cases):
    rows, expected = [], []
    for i, (summary, grade, details, p1, p2, blank) in enumerate(cases):
        sep = NL + NL if blank else NL
        text = f"{p1}Summary: {summary}{p2}{sep}Relevant: {grade}{NL}{p2}Details: {details}{p1}"
        rows.append((i, text))
        g = grade.capitalize()
        expected.append((summary, g, details if g in ("Yes", "Maybe") else ""))
    df = spark.createDataFrame(rows, "id int, response string")
    got = {r.id: (r.description, r.relevant_eo, r.full_summary) for r in parse_response(df).collect()}
    assert [got[i] for i in range(len(rows))] == expected
