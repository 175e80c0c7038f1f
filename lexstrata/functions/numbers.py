"""Numbers of structural elements: Roman, dotted, superscript, with closing marks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode superscript digits, and letters that look alike in two alphabets.
SUPERSCRIPTS, DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"
LATIN, CYRILLIC = "aeocpxy", "аеосрху"
# Ordinal stems.
ORDINALS = {"перв": 1, "втор": 2, "трет": 3, "четверт": 4, "пят": 5, "шест": 6, "седьм": 7, "восьм": 8, "девят": 9, "десят": 10}
ROMAN = "^(?=[IVXLCDM])M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with a value that is worked out once, however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def roman_value(text: Column) -> Column:
    """Value of a Roman number, null for other texts: a digit below its successor counts negative."""

    def value(upper: Column) -> Column:
        digits = [F.lit(v) * (F.length(upper) - F.length(F.replace(upper, F.lit(c), F.lit("")))) for c, v in zip("IVXLCDM", (1, 5, 10, 50, 100, 500, 1000), strict=True)]
        below = [F.when(upper.contains(a) | upper.contains(b), F.lit(-2 * v)).otherwise(0) for a, b, v in (("IV", "IX", 1), ("XL", "XC", 10), ("CD", "CM", 100))]
        return F.when(upper.rlike(ROMAN), reduce(Column.__add__, digits + below))

    return once(F.upper(F.trim(text)), value)


def superscripts_to_digits(text: Column) -> Column:
    return F.translate(text, SUPERSCRIPTS, DIGITS)


def sup_tags_to_unicode(text: Column) -> Column:
    """<sup>12</sup> as superscript digits."""
    parts = F.split(text, "(?i)<sup>")
    head = F.element_at(parts, 1)
    tail = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.concat(F.translate(F.regexp_extract(p, "(?is)^\\s*(\\d*)\\s*</sup>", 1), DIGITS, SUPERSCRIPTS), F.regexp_replace(p, "(?is)^\\s*\\d*\\s*</sup>", "")))
    return F.concat(head, F.array_join(tail, ""))


def clean_number(text: Column) -> Column:
    """Normal form for comparison: '1)', '1.' and '1' agree, Roman becomes Arabic, look-alike letters Cyrillic."""
    bare = F.regexp_replace(F.trim(F.regexp_replace(text.cast("string"), "<[^>]+>", "")), "[\"«»“”'(,;:]", "")
    bare = F.regexp_replace(bare, "[.)]+$", "")
    digits = lambda b: F.regexp_replace(b, "^0+(?=\\d+$)", "")
    return once(bare, lambda b: F.coalesce(roman_value(b).cast("string"), F.translate(F.lower(digits(b)), LATIN, CYRILLIC)))


def item_number(item_type: Column, number: Column) -> Column:
    """Points and subpoints end in ')'."""
    bare = F.trim(F.regexp_replace(F.coalesce(number.cast("string"), F.lit("")), "[\"«»]", ""))
    return F.when(item_type.isin("point", "subpoint") & (bare != "") & ~bare.endswith(")"), F.concat(F.regexp_replace(bare, "\\.$", ""), F.lit(")"))).otherwise(bare)


def number_tuple(text: Column) -> Column:
    """'1.2)' as [1, 2]; parts that aren't numbers are left out; [0] if nothing is left. A superscript is a further part."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"([{SUPERSCRIPTS}]+)", ".$1")
    parts = F.split(superscripts_to_digits(F.regexp_replace(plain, "\\)", "")), "\\.")
    kept = F.transform(F.filter(parts, lambda p: F.trim(p).rlike("^\\d{1,9}$")), lambda p: F.trim(p).cast("int"))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(0)))


def number_matches(item_type: Column, item: Column, wanted: Column) -> Column:
    """Whether an item has the wanted number; no number fits any table, appendix or preamble, and else only items without one."""
    none = F.coalesce(F.trim(wanted.cast("string")), F.lit("")) == ""
    bare = F.coalesce(F.trim(item.cast("string")), F.lit("")) == ""
    return F.when(none, item_type.isin("structured_table", "appendix", "preamble") | bare).otherwise(F.coalesce(clean_number(item) == clean_number(wanted), F.lit(False)))


def ordinal(word: Column) -> Column:
    """1 to 10 from an ordinal word or digits."""
    low = F.lower(F.trim(word))
    by_word = reduce(lambda acc, kv: F.when(low.startswith(kv[0]), F.lit(kv[1])).otherwise(acc), reversed(ORDINALS.items()), F.lit(None).cast("int"))
    return F.coalesce(F.when(low.rlike("^\\d{1,9}$"), low.cast("int")), by_word)


def number_path(text: Column) -> Column:
    """'1)->a)' or '1.2->3' as normalised numbers, outermost first."""
    return F.filter(F.transform(F.split(text, "\\s*(->|→)\\s*"), lambda p: clean_number(F.element_at(F.split(F.trim(p), "\\s+"), -1))), lambda p: p != "")


def shown_number(number: Column, header: Column, titled: Column) -> Column:
    """A number as rendered: headers end in '.' only if a title follows, others in '.' unless they end in a mark; '' for none."""
    own = F.trim(F.coalesce(number.cast("string"), F.lit("")))
    dotted = F.when(own.endswith("."), own).otherwise(F.concat(own, F.lit(".")))
    in_text = F.when(own.endswith(")"), own).otherwise(dotted)
    return F.when(own == "", own).when(header & titled, dotted).when(header, F.regexp_replace(own, "\\.+$", "")).otherwise(in_text)


def shift_position(position: Column, threshold: Column, delta: Column) -> Column:
    """'M-N' with M moved by delta from the threshold on; other forms stay."""
    first = F.regexp_extract(position, "^(\\d{1,9})-", 1)
    moved = F.concat((F.try_to_number(first, F.lit("999999999")).cast("int") + delta).cast("string"), F.regexp_extract(position, "^\\d+(-.*)$", 1))
    return F.when((first != "") & (F.try_to_number(first, F.lit("999999999")) >= threshold), moved).otherwise(position)
