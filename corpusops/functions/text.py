"""Text and log expressions: tails, sections, defaults, line access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line breaks of Python text, and the messages and sizes of log handling.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
NEWLINE = r"\r\n|\n|\r"
NO_SECTION = "Could not find a coverage table in the output. Is pytest-cov installed? Raw output:\n"
TAIL_CHARS = 4000
FALLBACK_TAIL_CHARS = 2000


def tail(text: Column, n: int = TAIL_CHARS) -> Column:
    """The last ``n`` characters."""
    return F.right(text, F.lit(n))


def lines(text: Column, breaks: str = LINE_BREAK) -> Column:
    """Lines without their breaks; a final break opens no further line, empty text has none."""
    parts = F.split(text, breaks, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def slice_lines(text: Column, start: Column, end: Column) -> Column:
    """Lines ``start`` to ``end`` (1-based, inclusive), broken at newlines only."""
    count = F.greatest(end - start + 1, F.lit(0))
    return F.array_join(F.slice(F.split(text, NEWLINE, -1), start, count), "\n")


def first_line(text: Column) -> Column:
    return F.regexp_extract(text, r"^[^\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]*", 0)


def section_from(parts: Column, marker: Column, raw: Column) -> Column:
    """From the first line that starts with ``marker`` to the end; else a message and the raw tail.

    ``parts`` are the lines of ``raw``; pass a projected column, so that they are split once.
    """
    at = F.array_position(F.transform(parts, lambda line: line.startswith(marker)), F.lit(True))
    found = F.array_join(F.slice(parts, at.cast("int"), F.size(parts)), "\n")
    return F.when(at > 0, found).otherwise(F.concat(F.lit(NO_SECTION), tail(raw, FALLBACK_TAIL_CHARS)))


def is_blank(text: Column) -> Column:
    """Nothing but whitespace, Unicode spaces included."""
    return F.regexp_like(text, F.lit(r"(?U)^[\s\x1c-\x1f]*$"))


def default_if_blank(text: Column, message: str) -> Column:
    return F.when(is_blank(text), F.lit(message)).otherwise(text)


def joined_output(stdout: Column, stderr: Column) -> Column:
    return F.concat(F.coalesce(stdout, F.lit("")), F.lit("\n"), F.coalesce(stderr, F.lit("")))


def percent(ratio: Column, digits: int = 1) -> Column:
    """Display only: rounds half up."""
    return F.format_string(f"%.{digits}f%%", ratio * 100)


def decimals(value: Column, digits: int = 3, signed: bool = False) -> Column:
    """Display only: rounds half up."""
    return F.format_string(f"%{'+' if signed else ''}.{digits}f", value)
