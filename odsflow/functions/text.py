"""Text and line expressions, all built in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def scrub(text: Column) -> Column:
    """NULL becomes empty, single quotes get a backslash, line feeds become blanks."""
    filled = F.coalesce(text, F.lit(""))
    quoted = F.replace(filled, F.lit("'"), F.lit("\\'"))
    return F.replace(quoted, F.lit("\n"), F.lit(" "))


def escape_line_breaks(text: Column) -> Column:
    """Line feeds and carriage returns as \\n and \\r, backslashes doubled, so that a field stays on one line."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_line_breaks(text: Column) -> Column:
    """The text that `escape_line_breaks` made a line of."""
    parts = F.split(text, "\\\\\\\\", -1)  # between doubled backslashes
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(plain, "\\")).otherwise(text)


def yes_flag(flag: Column) -> Column:
    """`YES` or `Y` (any case) to 1, all else, NULL included, to 0."""
    return F.when(F.upper(flag).isin("YES", "Y"), 1).otherwise(0)


def distinct_chars(text: Column) -> Column:
    """The different characters of a string in first-seen order."""
    return F.array_join(F.array_distinct(F.split(text, "")), "")


#: The message of the reference flow: a name and an age.
NAME_AGE = (("name", "string"), ("age", "int"))


def split_fields(line: Column, fields: Sequence[tuple[str, str]] = NAME_AGE, delimiter: str = "#") -> Column:
    """A delimited line as a struct of the declared (name, type) fields and `ok`.

    A line is good only with exactly the declared number of fields, each of which its type can
    hold; counting the fields matters, since a short line would still fill the first ones.
    """
    parts = F.split(line, f"\\Q{delimiter}\\E", -1)
    values = [F.get(parts, F.lit(i)).try_cast(kind) for i, (_, kind) in enumerate(fields)]
    good = F.size(parts) == len(fields)
    for value in values:
        good = good & value.isNotNull()
    return F.struct(*[v.alias(name) for v, (name, _) in zip(values, fields)], F.coalesce(good, F.lit(False)).alias("ok"))
