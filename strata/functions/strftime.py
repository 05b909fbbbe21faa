"""Native check that a string parses under a C ``strftime`` pattern.

``to_timestamp`` with a Java pattern is not the same test as Python's
``datetime.strptime`` (it accepts ``006/25/2014`` and rejects two blanks
between date and time), so the pattern is compiled into a Java regex that
accepts exactly the token forms ``strptime`` accepts, plus a calendar check
with ``try_to_date``.  Everything stays a JVM expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms Python's strptime accepts for each directive
# (numeric directives only).  Day allows a blank-padded single digit.
_TOKENS = {
    "m": "(1[0-2]|0[1-9]|[1-9])",
    "d": "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])",
    "Y": "((?!0000)[0-9]{4})",
    "y": "([0-9]{2})",
    "H": "(2[0-3]|[01][0-9]|[0-9])",
    "I": "(1[0-2]|0[1-9]|[1-9])",
    "M": "([0-5][0-9]|[0-9])",
    "S": "(6[01]|[0-5][0-9]|[0-9])",
    "j": "(36[0-6]|3[0-5][0-9]|[12][0-9][0-9]|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9])",
    "%": "(%)",
}


def compile_strftime(fmt: str) -> tuple[str, dict[str, int]]:
    """Translate ``fmt`` into an anchored Java regex.

    Returns the regex and the capture-group index of each directive.  Any
    whitespace run in the pattern matches one or more whitespace characters,
    as in ``strptime``.  Unsupported directives raise ``ValueError`` when the
    rule is built, not when it runs.
    """
    out = ["^"]
    groups: dict[str, int] = {}
    group_no = 0
    i = 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%":
            if i + 1 >= len(fmt):
                raise ValueError(f"dangling % in {fmt!r}")
            token = fmt[i + 1]
            if token not in _TOKENS:
                raise ValueError(f"unsupported strftime directive %{token} in {fmt!r}")
            group_no += 1
            if token != "%":
                groups.setdefault(token, group_no)
            out.append(_TOKENS[token])
            i += 2
        elif ch.isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            out.append(r"\s+")
        else:
            out.append(re.escape(ch))
            i += 1
    out.append(r"\z")
    return "".join(out), groups


def matches_strftime(col: Column | str, fmt: str) -> Column:
    """True when ``col`` parses under ``fmt``; NULL input gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    regex, groups = compile_strftime(fmt)
    ok = c.rlike(regex)
    if {"m", "d"} <= groups.keys():
        # Calendar check (2/30, or 2/29 of a common year, must fail): one more
        # regex pass rewrites the matched text to "Y-m-d" through group
        # references, instead of one extract per component.  As in strptime, a
        # two-digit year from 69 on is 19xx, and no year at all is 1900.
        day = f"-${groups['m']}-${groups['d']}"
        if "Y" in groups:
            ymd = F.regexp_replace(c, regex, f"${groups['Y']}{day}")
        elif "y" in groups:
            short = F.regexp_replace(c, regex, f"${groups['y']}{day}")
            ymd = F.concat(F.when(F.substring(short, 1, 2) >= "69", F.lit("19")).otherwise(F.lit("20")), short)
        else:
            ymd = F.regexp_replace(c, regex, f"1900{day}")
        ok = ok & F.try_to_date(F.regexp_replace(ymd, " ", ""), "yyyy-M-d").isNotNull()
    return F.when(c.isNotNull(), ok)
