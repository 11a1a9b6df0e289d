"""Text functions. Regular expressions carry Unicode flags, since Java's classes are ASCII by default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.patterns import Grammar, any_of

#: Unicode's white space. Trimming by characters is linear; an expression for what is at the end isn't.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Bullets that mark a raw line as an item, and the marks that are taken off with them.
BULLETS = "•▪"
ITEM_MARKS = BULLETS + r"\-–*"


def strip(c: Column) -> Column:
    """Without white space, of any kind, at both ends."""
    return F.btrim(c, F.lit(WHITE))


def is_present(c: Column) -> Column:
    return c.isNotNull()


def is_nonblank(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def is_furniture(c: Column, g: Grammar) -> Column:
    return c.rlike(g.furniture())


def is_bullet(raw: Column) -> Column:
    return strip(raw).rlike(f"^[{BULLETS}]")


def clean_line(raw: Column, g: Grammar | None = None) -> Column:
    """A line without control bytes, bullets and white space around; empty if it is page furniture."""
    c = F.regexp_replace(strip(raw), r"[\x07\x1f]", "")
    c = F.regexp_replace(c, rf"^[{ITEM_MARKS}][{ITEM_MARKS}\s]*", "")
    c = strip(F.regexp_replace(c, r"^\$?\\bullet\$?\s*", ""))
    return c if g is None else F.when(is_furniture(c, g), F.lit("")).otherwise(c)


def clean_field(c: Column) -> Column:
    """A field with line ends as line feeds, single spaces, and two line feeds in a row at most."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n")
    c = F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return strip(c)


def capitalised(c: Column) -> Column:
    """The first letter in upper case; what is before it and after it stays."""
    parts = [F.regexp_extract(c, r"(?s)^(\P{L}*)(\p{L})(.*)$", i) for i in (1, 2, 3)]
    return F.when(c.rlike(r"\p{L}"), F.concat(parts[0], F.upper(parts[1]), parts[2])).otherwise(c)


def cut_narration(c: Column, g: Grammar) -> Column:
    """Back to the last whole sentence before the narration's first word, if the narration is there at all."""
    at = F.regexp_instr(c, F.lit(f"(?iu){g.narration_cut}"))
    before = F.substr(c, F.lit(1), at - 1)
    return F.when(c.rlike(f"(?iu){g.narration}"), F.when(at > 0, F.regexp_extract(before, r"(?s)^(.*[.?!]) ", 1)).otherwise(F.lit(""))).otherwise(c)


BEHIND = r"(?=[\s.,;:)\]]|$)"
#: Numbers in a row. What a list may end with is decided range by range, and no step back is ever needed, so a list of any length takes no stack.
_RANGE = rf"\d{{1,3}}+(?!\d)(?:[\-–]\d{{1,3}}+(?!\d))*+{BEHIND}"
NUMBERS = rf"{_RANGE}(?:[,.]{_RANGE})*+"


def footnotes_general(g: Grammar | None = None) -> str:
    """A number glued to a lower-case letter or a closing mark, but not behind a unit or a name that carries numbers."""
    g = g or Grammar()
    return rf"(?=\d)(?<=[\p{{Ll}})%\]”’»\"])(?<!(?iu:{any_of(g.units)}))(?<!{any_of(g.numbered)})({NUMBERS})"


def footnotes_acronym(g: Grammar) -> str:
    return rf"(?<!\p{{L}})({any_of(g.acronyms)})({NUMBERS})"


def strip_footnotes(c: Column, g: Grammar | None = None) -> Column:
    c = F.regexp_replace(c, footnotes_general(g), "")
    return F.regexp_replace(c, footnotes_acronym(g), "$1") if g is not None and g.acronyms else c


def footnote_count(c: Column, g: Grammar | None = None) -> Column:
    """How many numbers strip_footnotes takes out: a list counts each, a range its two ends."""
    runs = F.regexp_extract_all(c, F.lit(footnotes_general(g)), F.lit(1))
    if g is not None and g.acronyms:
        left = F.regexp_replace(c, footnotes_general(g), "")
        runs = F.concat(runs, F.regexp_extract_all(left, F.lit(footnotes_acronym(g)), F.lit(2)))
    return F.coalesce(F.aggregate(F.transform(runs, lambda r: F.regexp_count(r, F.lit(r"\d+"))), F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")


def after_marker(c: Column, marker: str) -> Column:
    """What follows the marker's first occurrence; null where there is none."""
    return F.when(c.rlike(f"(?iu){marker}"), F.get(F.split(c, f"(?iu){marker}", 2), F.lit(1)))


def sentence_count(c: Column) -> Column:
    return F.coalesce(F.size(F.filter(F.split(c, r"[.!?]+"), lambda x: x.rlike(r"(?U)\S"))), F.lit(0)).cast("long")


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\w+")), F.lit(0)).cast("long")


def token_count(c: Column) -> Column:
    """Runs that white space parts."""
    return F.coalesce(F.size(F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")), F.lit(0)).cast("long")


LEAK = r"(?U)\.\s\d+(?:\.\d+){0,3}\.?\s\p{Lu}[^.:]*$"
HYPHEN = r"\p{Ll}-\s+\p{Ll}"


def has_leak(c: Column) -> Column:
    """Ends with a numbered heading that runs on from the sentence before."""
    return F.coalesce(F.rtrim(c).rlike(LEAK), F.lit(False))


def has_hyphen(c: Column) -> Column:
    return F.coalesce(c.rlike(HYPHEN), F.lit(False))


def hyphen_words(c: Column) -> Column:
    """The words around the first residual hyphen, without marks at their ends. The hyphen is found first and the words are cut around it, so
    a text of any length is read once."""
    at = F.regexp_instr(c, F.lit(f"(?U){HYPHEN}"))
    spaced = lambda x: F.translate(x, WHITE, " " * len(WHITE))
    words = F.array(F.substring_index(spaced(F.substr(c, F.lit(1), at + 1)), " ", -1), F.substring_index(F.ltrim(spaced(F.substr(c, at + 2))), " ", 1))
    trimmed = F.transform(words, lambda w: F.regexp_replace(w, r"^[^\p{L}\-]++|(?<![^\p{L}\-])[^\p{L}\-]++$", ""))
    return F.when(has_hyphen(c), F.array_join(trimmed, " "))


def strip_label(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*(?:[a-z]\)|[a-z0-9]\.\d+\.)\s*", "")


def labelled(parts: list[tuple[str | Column, Column]], dash: bool = True) -> Column:
    """Lines "- Label: value" for the values that aren't blank."""
    lines = []
    for label, value in parts:
        label = F.lit(label) if isinstance(label, str) else label
        lines.append(F.when(is_nonblank(value), F.concat(F.lit("- " if dash else ""), label, F.lit(": "), strip(value))))
    return F.concat_ws("\n", *lines)


def length_ratio(source: Column, target: Column, least: int = 40) -> Column:
    """Characters of target to source; null for sources under `least` characters."""
    s, t = (strip(F.coalesce(c, F.lit(""))) for c in (source, target))
    return F.when(F.length(s) >= least, F.length(t) / F.length(s))


def canonical(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def percent(c: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(c, digits), F.lit("%"))
