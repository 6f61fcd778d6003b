"""Plain text of HTML as one column expression.

Comments and the contents of scripts, styles and the like go, block elements end a
line, other tags vanish, character references become characters. Repeated groups
are possessive, so that markup of any length needs no recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.llm.spans import let

HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|noscript|template|svg)\b[^>]*+(?:>.*?(?:</\1\s*+>|\z)|\z)"
# A tag or a quote that never closes takes the rest of the page, as it does for a
# browser; so what a search has gone through is never gone through again.
ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))*+(?:>|\z)"
BLOCKS = (
    r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr"
    r"|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b" + ATTRIBUTES
)
TAGS = r"<[/!?]?[A-Za-z]" + ATTRIBUTES + r"|<[/!?][^>]*+(?:>|\z)"
NUMBERED = r"^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6})$"
# Named references that are resolved.
NAMED = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "trade": "™", "middot": "·",
    "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•",
    "laquo": "«", "raquo": "»", "euro": "€", "amp": "&",
}


def _numbered(name: Column) -> Column:
    """The character of a numeric reference, given what lies between & and ;.
    U+FFFD for a number that is no character."""
    inner = F.substr(name, F.lit(2))
    number = F.when(F.lower(F.substring(inner, 1, 1)) == "x", F.conv(F.substr(inner, F.lit(2)), 16, 10)).otherwise(inner).cast("long")
    known = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    wide = F.unhex(F.lpad(F.hex(F.when(known, number).otherwise(F.lit(0xFFFD).cast("long"))), 8, "0"))
    return F.decode(wide, "UTF-32")


def _references(text: Column) -> Column:
    """Character references resolved in one pass; what is none stays as it is."""
    named = F.create_map(*(F.lit(x) for pair in NAMED.items() for x in pair))

    def resolved(part: Column) -> Column:
        def known(name: Column) -> Column:
            char = F.when(name.rlike(NUMBERED), _numbered(name)).otherwise(F.try_element_at(named, name))
            after = F.substr(part, F.length(name) + 2)
            return F.when(F.length(name) < F.length(part), F.concat(char, after))

        return F.coalesce(let(F.substring_index(part, ";", 1), known), F.concat(F.lit("&"), part))

    def joined(parts: Column) -> Column:
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), resolved), ""))

    return let(F.split(text, "&", -1), joined)


def plain_text(html: Column) -> Column:
    """Lines of visible text, spaces collapsed, at most one empty line in a row."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, BLOCKS, "\n")
    text = F.regexp_replace(text, TAGS, "")
    text = _references(text)
    text = F.regexp_replace(text, r"[\x20\x09\x0B\x0C\x0D]++", " ")
    # One line end, or two for any number more.
    return F.btrim(F.regexp_replace(text, r" ?\n ?(?:(\n) ?(?:\n ?)*+)?", "\n$1"), F.lit(" \n"))
