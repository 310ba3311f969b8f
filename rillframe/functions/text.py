"""Text expressions."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, functions as F

UNITS = 0x10000
SURROGATES = range(0xD800, 0xE000)
FEW = 16


def word_count(text: Column) -> Column:
    """Words between single spaces, as a Java split counts them.

    Empty pieces at the end are dropped, empty pieces elsewhere count; an empty
    text is one (empty) word and a text of spaces only has none.
    """
    cut = F.rtrim(text)
    return (
        F.when(text == "", F.lit(1))
        .when(cut == "", F.lit(0))
        .otherwise(F.length(cut) - F.length(F.replace(cut, F.lit(" "), F.lit(""))) + 1)
    )


def words(text: Column) -> Column:
    """The pieces between single spaces; empty pieces are kept."""
    return F.split(text, " ")


def first_letter(word: Column) -> Column:
    """Lower-case first letter; an empty word has the key ''."""
    return F.lower(F.substring(word, 1, 1))


def is_lower(word: Column) -> Column:
    """Equal to its own lower case, so also true for digits and punctuation."""
    return word == F.lower(word)


@cache
def _alphabet(shift: int) -> tuple[str, str]:
    """All characters of one UTF-16 unit whose shifted unit is again a character."""
    pairs = [
        (chr(unit), chr((unit + shift) % UNITS))
        for unit in range(1, UNITS)
        if unit not in SURROGATES and (unit + shift) % UNITS not in SURROGATES and (unit + shift) % UNITS
    ]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _has_odd(text: Column, shift: int) -> Column:
    """Whether a text has characters that ``_alphabet`` leaves out."""
    odd = [unit for unit in range(UNITS) if unit not in SURROGATES
           and (unit == 0 or (unit + shift) % UNITS in SURROGATES or (unit + shift) % UNITS == 0)]
    beyond = F.octet_length(F.encode(text, "UTF-16BE")) > F.char_length(text) * 2
    if len(odd) <= FEW:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(chr(unit))) for unit in odd], beyond)
    inside = "".join(f"\\x{{{unit:x}}}" for unit in odd)
    return beyond | F.rlike(text, F.lit(f"[{inside}]"))


def _units(text: Column) -> Column:
    hexed = F.hex(F.encode(text, "UTF-16BE"))
    starts = F.sequence(F.lit(1), F.length(hexed), F.lit(4))
    units = F.transform(starts, lambda at: F.conv(F.substring(hexed, at, F.lit(4)), 16, 10).cast("int"))
    return F.when(F.length(hexed) == 0, F.array().cast("array<int>")).otherwise(units)


def _well_formed(units: Column) -> Column:
    """Every high surrogate is followed by a low one and the reverse."""
    high = F.transform(units, lambda u: u.between(0xD800, 0xDBFF))
    low = F.transform(units, lambda u: u.between(0xDC00, 0xDFFF))
    after_high = F.concat(F.array(F.lit(False)), high)
    before_end = F.concat(low, F.array(F.lit(False)))
    return after_high == before_end


def _shift_units(text: Column, shift: int) -> Column:
    moved = F.transform(_units(text), lambda u: F.pmod(u + shift, F.lit(UNITS)))
    joined = F.array_join(F.transform(moved, lambda u: F.lpad(F.hex(u), 4, "0")), "")
    return F.when(_well_formed(moved), F.decode(F.unhex(joined), "UTF-16BE"))


def shift_text(text: Column, shift: int) -> Column:
    """Shift every UTF-16 unit, without wrapping inside an alphabet.

    Plain ASCII goes through a short ``translate``, nearly all other texts
    through a long one. Texts with characters beyond
    one unit, or whose shifted unit is no character, are shifted unit by unit;
    the result is NULL where the shifted units form no valid text.
    """
    if shift % UNITS == 0:
        return text
    source, target = _alphabet(shift % UNITS)
    short = [(s, t) for s, t in zip(source, target) if ord(s) < 128]
    plain = (F.octet_length(text) == F.length(text)) if len(short) == 128 else F.lit(False)
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(plain, F.translate(text, "".join(s for s, _ in short), "".join(t for _, t in short)))
        .when(_has_odd(text, shift % UNITS), _shift_units(text, shift))
        .otherwise(F.translate(text, source, target))
    )
