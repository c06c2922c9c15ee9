"""String column functions (survey IDs STR1-STR12, COL4, ARR1).

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import os

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The whitespace set of Python's ``str.isspace`` / ``str.strip()`` / ``re``
# ``\s``, which the archive's cleanup and strip rules are defined by:
# TAB LF VT FF CR, FS GS RS US (0x1C-0x1F), SPACE, NEL (0x85), NBSP (0xA0),
# OGHAM SPACE MARK (0x1680), EN QUAD..HAIR SPACE (0x2000-0x200A), LINE
# SEPARATOR (0x2028), PARAGRAPH SEPARATOR (0x2029), NARROW NBSP (0x202F),
# MEDIUM MATHEMATICAL SPACE (0x205F), IDEOGRAPHIC SPACE (0x3000).
# Written with \x{...} escapes, which both Java regex and RE2 accept.
WS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set as Java matches it fastest: Unicode White_Space plus 0x1C-0x1F.
# Valid only in patterns that start with the (?U) flag.
WS_U = r"[\s\x{1C}-\x{1F}]"
# Characters a file name may not hold; each becomes "_".
UNSAFE_FILENAME_CHARS = r'[\\/:*?"<>|]'
# Separator of the archive's joined ``types`` string.
TYPES_SEP = "; "
# Item type used when a listing item carries no category.
NO_TYPES = "no types"
# Dashboard label of an empty grade.
UNLABELED = "Unlabeled"
# Grades recognised in archive text (case-sensitive, whole word).
GRADE_PATTERN = r"(?U)\b(Yes|No|Maybe)\b"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """Every run of whitespace becomes one space (no strip)."""
    return F.regexp_replace(_c(c), "(?U)" + WS_U + "+", " ")


def strip_ws(c) -> Column:
    """STR3: strip leading and trailing whitespace (full Unicode set)."""
    return F.regexp_replace(_c(c), "(?U)^" + WS_U + "+|" + WS_U + "+$", "")


def clean_text(c) -> Column:
    """STR1: collapse whitespace runs to one space, then strip."""
    # after the collapse the only whitespace left is U+0020, which trim removes
    return F.trim(collapse_ws(c))


def safe_filename(c, max_len: int = 120) -> Column:
    """STR2: truncate to ``max_len`` characters, then replace unsafe ones."""
    return F.regexp_replace(F.substring(_c(c), 1, max_len), UNSAFE_FILENAME_CHARS, "_")


def text_file_path(output_dir: str, date, title, today: str) -> Column:
    """STR5: ``<dir>/<date> - <safe(title, 60)>.txt``.

    Blank dates fall back to ``today`` (a ``yyyy-MM-dd`` parameter, never the
    clock inside a query) and blank titles to ``untitled``.
    """
    d = F.coalesce(F.nullif(_c(date), F.lit("")), F.lit(today))
    t = F.coalesce(F.nullif(_c(title), F.lit("")), F.lit("untitled"))
    prefix = output_dir.rstrip("/") + "/" if output_dir else ""
    return F.concat(F.lit(prefix), d, F.lit(" - "), safe_filename(t, 60), F.lit(".txt"))


def topic_slug(topic) -> Column:
    """STR6: strip, truncate to 80, sanitise."""
    return safe_filename(strip_ws(topic), 80)


def topic_csv_name(base_csv: str, topic) -> Column:
    """SNK5: ``<root> - <slug><ext>`` beside ``base_csv``; blank topic -> base."""
    directory, base = os.path.split(base_csv)
    root, ext = os.path.splitext(base)
    ext = ext or ".csv"
    prefix = (directory or ".") + "/"
    t = _c(topic)
    named = F.concat(F.lit(prefix + root + " - "), topic_slug(t), F.lit(ext))
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(base_csv)).otherwise(named)


def split_types(c) -> Column:
    """STR7: split the joined types string, strip each, drop empties."""
    parts = F.split(F.coalesce(_c(c), F.lit("")), TYPES_SEP)
    return F.filter(F.transform(parts, strip_ws), lambda x: x != "")


def default_types(arr) -> Column:
    """STR4: an item without categories gets ``["no types"]``."""
    a = _c(arr)
    return F.when(F.coalesce(F.size(a), F.lit(0)) <= 0, F.array(F.lit(NO_TYPES))).otherwise(a)


def join_types(arr) -> Column:
    """COL4: list -> ``"; "``-joined string."""
    return F.array_join(_c(arr), TYPES_SEP)


def grade_of(c) -> Column:
    """STR8: first whole-word Yes/No/Maybe (case-sensitive); none -> ''."""
    return F.coalesce(F.regexp_extract(_c(c), GRADE_PATTERN, 1), F.lit(""))


def blank_label(c) -> Column:
    """STR11: empty grade -> ``Unlabeled``."""
    c = F.coalesce(_c(c), F.lit(""))
    return F.when(c == "", F.lit(UNLABELED)).otherwise(c)


def nonempty_lines(c) -> Column:
    """ARR1: lines split on LF, each stripped, empty ones dropped."""
    lines = F.split(F.coalesce(_c(c), F.lit("")), "\n")
    return F.filter(F.transform(lines, strip_ws), lambda x: x != "")


def display_or(c, fallback: str) -> Column:
    """COL5: blank -> ``fallback``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(fallback))
