"""Log headers and wildcard fields as column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparklogs.functions.times import parse_time

#: Fixed value: time, level, location up to the first colon, message; the dot matches line ends.
HEADER = r"(?s)^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})\s+(TRACE|DEBUG|INFO|WARN|ERROR|FATAL)\s+(.*?):\s*(.*)"


def parse_log_line(line: Column, tz: str = "UTC") -> Column:
    """struct(timestamp, level, location, message) of a line or a whole event with a header; null for others.

    The message is trimmed of white space, line ends too. A header whose time
    doesn't exist gives null as well.
    """
    part = lambda i: F.regexp_extract(line, HEADER, i)
    when = parse_time(part(1), tz)
    parsed = F.struct(
        when.alias("timestamp"),
        part(2).alias("level"),
        part(3).alias("location"),
        F.regexp_replace(part(4), r"^\s+|\s+$", "").alias("message"),
    )
    return F.when(line.rlike(HEADER) & when.isNotNull(), parsed)


def template_regex(template: str, literal: bool = False) -> str | None:
    """The regex of a wildcard template: `A*B` is a space-free text between A and B. None if there is no `*`.

    Parts are regexes themselves unless `literal`. With several stars the parts in
    between belong to the match.
    """
    parts = [re.escape(p) if literal else p for p in template.split("*")]
    if len(parts) == 1:
        return None
    inner = r"[\S]*".join(["", *parts[1:-1], ""])
    before = f"(?<={parts[0]})" if parts[0] else ""
    after = f"(?={parts[-1]})" if parts[-1] else ""
    return f"{before}{inner}{after}"


def extract_field(message: Column, template: str, literal: bool = False) -> Column:
    """First match of a wildcard template; null if none. Without a star: empty text if the template occurs."""
    pattern = template_regex(template, literal)
    if pattern is None:
        return F.when(message.rlike(re.escape(template) if literal else template), F.lit(""))
    return F.when(message.rlike(pattern), F.regexp_extract(message, f"({pattern})", 1))
