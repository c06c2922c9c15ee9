"""Prompt building and model-answer parsing (survey IDs ANN1, ANN5-ANN7).

The parser turns a free-text answer into ``(description, relevant_eo,
full_summary)`` with higher-order array functions only, so it runs in the
JVM over whole partitions; the model call itself lives in
``quarry.operators.annotate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import WS_U as WS, nonempty_lines, strip_ws

# --- fixed values -----------------------------------------------------------
SYSTEM_MESSAGE = "You are a careful and concise policy analyst."
PROMPT_HEAD = ("You are a policy analyst reviewing U.S. Presidential actions. "
               "Read the text and answer.\n")
SCOPE_LINE = ("Relevance scope: {topic}. Mark 'Relevant' only if the action materially "
              "concerns {topic} (not just tangential mentions).\n")
PROMPT_BODY = ("\nRespond in exactly three labeled lines, without numbering, like:\n"
               "Summary: <one sentence>\n"
               "Relevant: <Yes|No|Maybe>\n"
               "Details: <3-5 sentences if Relevant is Yes or Maybe; otherwise leave blank>\n\n"
               "Executive Action:\n")
DEFAULT_MODEL = "gpt-4o"
FALLBACK_MODEL = "gpt-4o-mini"
TEMPERATURE = 0.2
DEFAULT_GRADE = "No"
DETAIL_GRADES = ("Yes", "Maybe")
# Line-start labels (case-insensitive) that switch the parser to labelled mode.
SUMMARY_LINE = r"(?iuU)^" + WS + r"*summary" + WS + r"*:"
RELEVANT_LINE = r"(?iuU)^" + WS + r"*(?:relevant|relevance)" + WS + r"*:"
DETAILS_LINE = r"(?iuU)^" + WS + r"*details?" + WS + r"*:"
# Optional list marker, then a label word and an optional colon.
LABEL_PREFIX = (r"(?iuU)^" + WS + r"*(?:\d+[.)]" + WS + r"*|[-*]" + WS + r"*)?"
                r"(?:Summary|Relevant|Relevance|Details?):?" + WS + r"*")
# A grade anywhere in a labelled line.
ANY_GRADE = r"(?iuU)\b(Yes|No|Maybe)\b"
# A bare answer line in unlabelled mode.
ANSWER_LINE = (r"(?iuU)^" + WS + r"*(?:\d+[.)]" + WS + r"*)?(?:[-*]" + WS + r"*)?"
               r"(?:relevant|relevance)?(?:[:\-]|" + WS + r")*" + WS + r"*(Yes|No|Maybe)\b")
# ---------------------------------------------------------------------------


def prompt_text(text, topic: str | None = None) -> Column:
    """ANN1: the user message for one text; the scope line only with a topic."""
    scope = SCOPE_LINE.format(topic=topic.strip()) if topic else ""
    t = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(PROMPT_HEAD + scope + PROMPT_BODY), F.coalesce(t, F.lit("")))


def strip_label(c: Column) -> Column:
    """ANN6: drop a list marker and label prefix, then strip."""
    return strip_ws(F.regexp_replace(c, LABEL_PREFIX, ""))


def _capital(c: Column) -> Column:
    return F.initcap(F.lower(c))


def _last(arr: Column) -> Column:
    return F.get(arr, F.size(arr) - 1)


def _joined_tail(lines: Column, after: Column) -> Column:
    """Label-stripped lines with index > ``after``, space-joined, stripped."""
    tail = F.filter(lines, lambda _l, j: j > after)
    return strip_ws(F.array_join(F.transform(tail, strip_label), " "))


def parse_response(df: DataFrame, response: str = "response", *,
                   description: str = "description", grade: str = "relevant_eo",
                   details: str = "full_summary") -> DataFrame:
    """ANN5: add the three parsed columns for the answer in ``response``.

    Labelled mode (any line starts with a Summary/Relevant/Details label):
    description from the last summary line, grade from the last relevant
    line that names one (default No), details from the last details line
    plus every following line.  Otherwise: description from the first line,
    grade from the first bare answer line, details from the lines after it.
    Details only survive a Yes or Maybe grade.

    Intermediates are separate columns referenced by name, so each array
    pass runs once per row (Catalyst doesn't inline a non-trivial column
    that is used more than once).
    """
    lines, tagged = F.col("__lines"), F.col("__tagged")
    lab, det, ans = F.col("__lab"), F.col("__det"), F.col("__ans")
    head, tail = F.col("__head"), F.col("__tail")

    def kind(line):
        return (F.when(line.rlike(SUMMARY_LINE), 1).when(line.rlike(RELEVANT_LINE), 2)
                .when(line.rlike(DETAILS_LINE), 3).otherwise(0))

    def of_kind(k):
        return F.filter(tagged, lambda t: t["k"] == k)

    answers = F.filter(
        F.transform(lines, lambda l, i: F.struct(i.alias("i"), F.regexp_extract(l, ANSWER_LINE, 1).alias("g"))),
        lambda a: a["g"] != "")
    lab_grades = F.filter(F.transform(of_kind(2), lambda t: F.regexp_extract(t["l"], ANY_GRADE, 1)),
                          lambda g: g != "")
    lab_details = (F.when(det.isNull(), F.lit("")).when(tail == "", head).when(head == "", tail)
                   .otherwise(strip_ws(F.concat_ws(" ", head, tail))))
    fb_details = F.when(ans.isNull(), F.lit("")).otherwise(tail)
    return (
        df.withColumn("__lines", nonempty_lines(response))
        .withColumn("__tagged", F.transform(lines, lambda l, i: F.struct(
            l.alias("l"), i.alias("i"), kind(l).alias("k"))))
        .withColumn("__lab", F.exists(tagged, lambda t: t["k"] > 0))
        .withColumns({
            "__det": F.when(lab, _last(of_kind(3))["i"]),
            "__ans": F.when(~lab, F.get(answers, 0)),
        })
        .withColumns({
            description: F.coalesce(
                strip_label(F.when(lab, _last(of_kind(1))["l"]).otherwise(F.get(lines, 0))), F.lit("")),
            grade: F.coalesce(_capital(F.when(lab, _last(lab_grades)).otherwise(ans["g"])),
                              F.lit(DEFAULT_GRADE)),
            "__head": F.when(det.isNotNull(), strip_label(F.get(lines, det))),
            "__tail": _joined_tail(lines, F.when(lab, det).otherwise(ans["i"])),
        })
        .withColumn(details, F.when(F.col(grade).isin(*DETAIL_GRADES),
                                    F.when(lab, lab_details).otherwise(fb_details)).otherwise(F.lit("")))
        .drop("__lines", "__tagged", "__lab", "__det", "__ans", "__head", "__tail")
    )
