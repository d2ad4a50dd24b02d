"""Text transforms applied to a request field before it is matched.

All of them are Column expressions, evaluated in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The named HTML entities that are decoded.
NAMED_ENTITIES = {
    "quot": '"',
    "amp": "&",
    "lt": "<",
    "gt": ">",
    "apos": "'",
    "nbsp": "\u00a0",
}

# Separates query arguments after splitting. No match string contains it.
ARGUMENT_BREAK = "\n"


def unchanged(text: Column) -> Column:
    return text


def lowercase(text: Column) -> Column:
    return F.lower(text)


def url_decode(text: Column) -> Column:
    """Percent-decode. ``+`` stays a plus, and a ``%`` that starts no escape stays a ``%``.

    Only valid escapes are decoded, so one stray ``%`` cannot keep the rest of
    the text encoded and thereby hide it from the rules.
    """

    def decoded(escaped: Column) -> Column:
        plus_kept = F.replace(escaped, F.lit("+"), F.lit("%2B"))
        return F.try_url_decode(F.when(text.contains("%"), plus_kept))

    # Most text is well formed; stray signs are looked for only where it is not.
    stray_kept = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(decoded(text), decoded(stray_kept), text)


def _decoded_piece(piece: Column) -> Column:
    """Text that followed an ``&``: the entity's character and the rest, or the piece as it was."""
    name = F.substring_index(piece, ";", 1)
    rest = F.substr(piece, F.length(name) + 2)
    code = F.coalesce(
        F.regexp_extract(name, "^#0*([0-9]{1,7})$", 1).try_cast("int"),
        F.conv(F.nullif(F.regexp_extract(name, "^#[xX]0*([0-9A-Fa-f]{1,6})$", 1), F.lit("")), 16, 10).try_cast("int"),
    )
    # The character of a code point, by way of its four bytes in UTF-32. Surrogates are no characters.
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    for entity, value in NAMED_ENTITIES.items():
        char = F.when(name == entity, F.lit(value)).otherwise(char)
    as_it_was = F.concat(F.lit("&"), piece)
    return F.when(piece.contains(";"), F.coalesce(F.concat(char, rest), as_it_was)).otherwise(as_it_was)


def html_entity_decode(text: Column) -> Column:
    """Decode named entities and numeric ones of any character, each once: ``&amp;lt;`` gives ``&lt;``."""
    pieces = F.split(text, "&")
    decoded = F.array_join(
        F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_decoded_piece(piece))), ""
    )
    # Query strings are full of ``&``; only with a ``;`` can there be an entity.
    return F.when(text.contains("&") & text.contains(";"), decoded).otherwise(text)


def query_arguments_text(args: Column) -> Column:
    """Query string with arguments set apart, so that no match can span two of them.

    Splitting comes before decoding: an encoded ``%26`` inside an argument is
    text, a plain ``&`` is a boundary.
    """
    return F.replace(args, F.lit("&"), F.lit(ARGUMENT_BREAK))


# The transform names used in rule definitions.
TRANSFORMS = {
    "NONE": unchanged,
    "LOWERCASE": lowercase,
    "URL_DECODE": url_decode,
    "HTML_ENTITY_DECODE": html_entity_decode,
}


def transformed(field: Column, transforms: Sequence[str]) -> Column:
    """``field`` after the named transforms, in the order given."""
    for name in transforms:
        field = TRANSFORMS[name](field)
    return field


def byte_match(
    field: Column, needle: str | Column, transforms: Sequence[str] = (), constraint: str = "CONTAINS"
) -> Column:
    """Case-sensitive match of a transformed field. False, never NULL, for a missing field."""
    text = transformed(field, transforms)
    if constraint == "CONTAINS":
        hit = text.contains(needle)
    elif constraint == "EXACTLY":
        hit = text == needle
    else:
        raise ValueError(f"unknown positional constraint: {constraint}")
    return F.coalesce(hit, F.lit(False))
