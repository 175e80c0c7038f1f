"""Text and light markup as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inflected forms of the element types, by their base form.
TYPE_FORMS = {
    "статья": ("статья", "статьи", "статью", "статье", "статей"),
    "часть": ("часть", "части", "частью", "частей"),
    "пункт": ("пункт", "пункты", "пункта", "пункте", "пунктов", "пунктом"),
    "подпункт": ("подпункт", "подпункты", "подпункта", "подпункте", "подпунктов"),
    "абзац": ("абзац", "абзацы", "абзаца", "абзаце", "абзацев"),
    "глава": ("глава", "главы", "главу", "главе"),
    "раздел": ("раздел", "разделы", "раздела", "разделе"),
    "приложение": ("приложение", "приложения", "приложению"),
    "преамбула": ("преамбула", "преамбулы", "преамбулу", "преамбуле"),
    "таблица": ("таблица", "таблицы", "таблицу", "таблице"),
}
# Element types of the base forms.
TYPE_NAMES = {"статья": "article", "часть": "part", "пункт": "point", "подпункт": "subpoint", "абзац": "paragraph", "глава": "chapter", "раздел": "section", "приложение": "appendix", "преамбула": "preamble", "таблица": "structured_table"}
# Order of sibling types.
TYPE_ORDER = ("preamble", "section", "chapter", "article", "part", "point", "subpoint", "structured_table", "appendix", "nested_appendix")

_BASE = {form: base for base, forms in TYPE_FORMS.items() for form in forms}


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def base_type(word: Column) -> Column:
    """Base form of an inflected type word; other words in lower case; null gives ''."""
    low = F.lower(F.trim(F.coalesce(word, F.lit(""))))
    return F.coalesce(F.try_element_at(literal_map(_BASE), low), low)


def element_type(word: Column) -> Column:
    return F.try_element_at(literal_map(TYPE_NAMES), base_type(word))


def type_rank(item_type: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map({t: i for i, t in enumerate(TYPE_ORDER)}), item_type), F.lit(len(TYPE_ORDER)))


def squeezed(text: Column) -> Column:
    """Runs of white space, of any script, as one space; trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "(?U)\\s+", " "))


def without_tags(html: Column) -> Column:
    """Tags out, with nothing in their place; white space squeezed."""
    return squeezed(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", ""))


def without_thinking(text: Column) -> Column:
    """Thinking blocks and code fences out."""
    bare = F.regexp_replace(text, "(?is)<think(ing)?>.*?</think(ing)?>", "")
    return F.regexp_replace(F.regexp_replace(bare, "(?im)^```[a-z]*\\s*$", ""), "^\\s+|\\s+$", "")


def for_search(text: Column) -> Column:
    """Lower case, without punctuation, white space squeezed."""
    return F.lower(squeezed(F.regexp_replace(F.coalesce(text, F.lit("")), "(?U)[^\\w\\s]", "")))


def head_text(head: Column, type_word: Column, number: Column) -> Column:
    """A title without tags, entities, outer quotes and its own 'Type N.' at the start."""
    bare = F.regexp_replace(F.regexp_replace(without_tags(head), "&nbsp;|&#160;", " "), "^[«\"“]+|[»\"”]+$", "")
    start = F.concat(F.lower(type_word), F.lit(" "), F.regexp_replace(number.cast("string"), "[.)]+$", ""))
    low = F.lower(F.trim(bare))
    cut = F.regexp_replace(F.substring(F.trim(bare), F.length(start) + F.lit(1), F.length(bare)), "^[.)]*\\s*", "")
    return F.when(low.startswith(start), cut).otherwise(F.trim(bare))


def paragraphs(html: Column) -> Column:
    """Texts of the <p> blocks that aren't empty, or the whole text if there is none."""
    found = F.filter(F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?is)<p[^>]*>(.*?)</p>"), 1), without_tags), lambda p: p != "")
    whole = without_tags(html)
    return F.when(F.size(found) > 0, found).otherwise(F.when(whole != "", F.array(whole)).otherwise(F.expr("cast(array() AS array<string>)")))


def without_leading_number(html: Column, number: Column) -> Column:
    """The number, with its mark (if any) and the space after it, out of the text's first place."""
    bare = F.regexp_replace(number.cast("string"), "[.)]+$", "")
    text = F.regexp_replace(html, "^(\\s*(<[^>]+>)*)\\s+", "$1")
    tags = F.regexp_extract(text, "^(\\s*(?:<[^>]+>)*)", 1)
    rest = F.substring(text, F.length(tags) + F.lit(1), F.length(text))
    tail = F.substring(rest, F.length(bare) + F.lit(1), F.length(rest))
    hit = (bare != "") & rest.startswith(bare) & tail.rlike("^[.)\\s]")
    return F.when(hit, F.concat(tags, F.regexp_replace(tail, "^[.)]*(?U)\\s*", ""))).otherwise(html)


def with_number(html: Column, number: Column, item_type: Column) -> Column:
    """The number before the first block's text, 'N.' for parts and points and 'N)' for subpoints, unless it stands there already."""
    own = number.cast("string")
    shown = F.when(item_type == "subpoint", F.concat(F.regexp_replace(own, "\\.+$", ""), F.lit(")"))).otherwise(F.concat(own, F.lit(".")))
    tags = F.regexp_extract(html, "^(\\s*(?:<[^>]+>)*)", 1)
    rest = F.substring(html, F.length(tags) + F.lit(1), F.length(html))
    there = F.startswith(rest, shown) & F.substring(rest, F.length(shown) + F.lit(1), F.lit(1)).rlike("[\\s.)]")
    return F.when(item_type.isin("part", "point", "subpoint") & ~there, F.concat(tags, shown, F.lit(" "), rest)).otherwise(html)


def file_number(number: Column) -> Column:
    """A document number fit for a file name; 'unknown' if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(number, F.lit(""))), "^№\\s*", ""), "(?iu)-?\\s*(зс|з)$", "")
    return F.coalesce(F.nullif(F.regexp_replace(bare, "[^\\p{L}\\p{N}_-]", ""), F.lit("")), F.lit("unknown"))


def quote_depth(text: Column) -> Column:
    """Opening less closing guillemets."""
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return count("«") - count("»")


def replacement_pairs(text: Column) -> Column:
    """(old, new) of each 'слова «old» заменить словами «new»' in an instruction."""
    pattern = "«([^»]*)»\\s+заменить\\s+(?:словами?|словом|цифрами|числом)?\\s*«([^»]*)»"
    olds, news = (F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), g) for g in (1, 2))
    return F.arrays_zip(olds.alias("old"), news.alias("new"))


def change_type(text: Column) -> Column:
    """Kind of an instruction, first rule that fits: part of a sentence, new wording, deletion, addition, else change."""
    low = F.lower(squeezed(text))
    return (
        F.when(low.rlike("слов[аоу]|цифр|предложени"), "change")
        .when(low.rlike("изложить|в следующей редакции"), "new_redaction")
        .when(low.rlike("исключить|признать утратившим|утратил"), F.when(low.rlike("(стать|част|пункт|подпункт|абзац|глав|раздел|приложени)\\S*\\s+[0-9]"), "delete").otherwise("change"))
        .when(low.rlike("дополнить"), "add")
        .otherwise("change")
    )


def listed_numbers(text: Column) -> Column:
    """Numbers of '3-5, 7' one by one."""
    parts = F.split(F.regexp_replace(text, "[^0-9,\\-]", ""), ",")
    many = F.transform(F.filter(parts, lambda p: p.rlike("^\\d{1,6}(-\\d{1,6})?$")), lambda p: F.sequence(F.element_at(F.split(p, "-"), 1).cast("int"), F.greatest(F.element_at(F.split(p, "-"), 1).cast("int"), F.element_at(F.split(p, "-"), -1).cast("int"))))
    return F.flatten(many)
