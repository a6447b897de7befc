"""Character references of HTML in one pass over a text, as native column expressions.

A text is cut at its ampersands, and each part after the first says by its own beginning which character it stands for; what
comes out is never read again, so `&#38;lt;` is `&lt;` and nothing else. Names are looked up in the table of HTML 5, which
Python's standard library has.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^#(?:[xX]0*[0-9a-fA-F]{1,6}(?![0-9a-fA-F])|0*[0-9]{1,7}(?![0-9]));?"
NAME = r"^[A-Za-z][A-Za-z0-9]*;"
# A no-break space separates words like any other blank here.
NAMES = {name: " " if char == "\xa0" else char for name, char in html5.items()}
# Names that also count without a semicolon, the longest first, as a part begins with the longest that fits.
BARE = sorted((name for name in NAMES if not name.endswith(";")), key=lambda name: (-len(name), name))
# Numbers of the old control block stand for the characters that the Windows Latin code page has there.
_CODES = [n for n in range(0x80, 0xA0) if bytes([n]).decode("cp1252", "ignore")]
CONTROLS = "".join(map(chr, _CODES)), bytes(_CODES).decode("cp1252")


# Names that most pages use. They stand first in the table, where a look-up finds them at once.
COMMON = ["amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "lsquo;", "rsquo;", "ldquo;", "rdquo;", "ndash;", "mdash;", "hellip;", "copy;", "reg;"]
# The table as one text, since a plan with a map of this size is slow to compare and to print.
LONGEST = max(map(len, NAMES.values()))
TABLE = "\x01".join(["", *(f"{name}\x02{NAMES[name]}" for name in dict.fromkeys([*COMMON, *NAMES])), ""])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _part() -> str:
    """The text that an ampersand and the `part` after it stand for, as a lambda in SQL: written out node by node through the
    Python functions, it would take longer to build than to run."""
    number, name, bare = (f"nullif(regexp_extract(part, {_quoted(p)}, 0), '')" for p in (NUMBER, NAME, f"^(?:{'|'.join(BARE)})"))
    digits = f"regexp_replace({number}, '[#xX;]', '')"
    code = f"try_cast(if({number} RLIKE '^#[xX]', conv({digits}, 16, 10), {digits}) AS INT)"
    sign = f"translate(decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32'), {_quoted(CONTROLS[0])}, {_quoted(CONTROLS[1])})"

    def named(ref: str) -> str:
        entry = f"concat(chr(1), {ref}, chr(2))"
        place = f"nullif(instr({_quoted(TABLE)}, {entry}), 0)"
        return f"substring_index(substring({_quoted(TABLE)}, {place} + length({entry}), {LONGEST + 1}), chr(1), 1)"

    real = f"{code} BETWEEN 1 AND {0x10FFFF} AND {code} NOT BETWEEN {0xD800} AND {0xDFFF}"
    found = [(f"if({real}, {sign}, NULL)", number), (named(name), name), (named(bare), bare)]
    return f"part -> coalesce({', '.join(f'concat({char}, substring(part, length({ref}) + 1))' for char, ref in found)}, concat('&', part))"


PART = _part()


def resolved(text: Column) -> Column:
    """Text with its named and numbered character references replaced, each once; what names no character stays as it is."""
    def replaced(t: Column) -> Column:
        parts = F.split(t, "&")
        rest = F.call_function("transform", F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.expr(PART))
        return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))

    # through a list of one, so that the text is computed once
    once = F.transform(F.array(text), lambda t: F.when(F.contains(t, F.lit("&")), replaced(t)).otherwise(t))
    return F.get(once, F.lit(0))
