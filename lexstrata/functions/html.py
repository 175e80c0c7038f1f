"""Light HTML as column expressions: blocks, rows, leading numbers, answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_BLOCK = "\\s*<p[^>]*>\\s*(?:&nbsp;|\\s|<br/?>)*</p>\\s*"
BLOCK = "(?is)<p[^>]*>.*?</p>"
LEADING = "^(\\d+(?:\\.\\d+)?|[а-яё])[.)]"


def some(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def bare_text(html: Column) -> Column:
    """Text without tags, white space squeezed; nothing stands in for a tag."""
    return F.trim(F.regexp_replace(F.regexp_replace(some(html), "<[^>]+>", ""), "(?U)\\s+", " "))


def trimmed(html: Column, table_child: Column | None = None) -> Column:
    """Without empty blocks at its ends; a table's child keeps its table's rows only, one a line."""
    out = F.regexp_replace(F.regexp_replace(some(html), f"(?i)^(?:{EMPTY_BLOCK})+", ""), f"(?i)(?:{EMPTY_BLOCK})+$", "")
    if table_child is not None:
        rows = F.regexp_extract_all(out, F.lit("(?is)<tr\\b.*?</tr>"), 0)
        out = F.when(table_child & (F.size(rows) > 0), F.array_join(rows, "\n")).otherwise(out)
    return F.trim(out)


def unquoted(text: Column) -> Column:
    return F.regexp_replace(text, "^[«»\"'“”‘’\\s]+", "")


def leading_number(html: Column) -> Column:
    """The number or letter, with a mark behind it, that the first block starts with; null if there is none."""
    first = F.coalesce(F.nullif(F.regexp_extract(some(html), "(?is)<(p|div)\\b[^>]*>(.*?)</\\1>", 2), F.lit("")), some(html))
    return F.nullif(F.regexp_extract(unquoted(bare_text(first)), LEADING, 1), F.lit(""))


def description(html: Column) -> Column:
    """Trimmed, without the white space before its first text."""
    return F.regexp_replace(F.trim(html), "(?U)^((?:<[^>]+>)*)\\s+", "$1")


def blocks_and_gaps(html: Column) -> Column:
    """<p> blocks and what stands between them, in order, without empty ones."""
    marked = F.regexp_replace(F.trim(some(html)), BLOCK, "\u0001$0\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda x: F.trim(x)), lambda x: x != "")


def fragments_by_number(html: Column, numbers: Column) -> Column:
    """(marker, html) of the stretches of blocks that start with one of the numbers; without any marker, all under the first number."""
    found = F.regexp_extract_all(some(html), F.lit(BLOCK), 0)
    paragraphs = F.when(F.size(found) > 0, found).otherwise(F.transform(F.filter(F.split(F.trim(some(html)), "\\n\\s*\\n"), lambda x: F.trim(x) != ""), lambda x: F.concat(F.lit("<p>"), F.trim(x), F.lit("</p>"))))
    marker = lambda p: F.nullif(F.regexp_extract(F.trim(unquoted(F.regexp_replace(F.regexp_replace(p, "<[^>]+>", ""), "&nbsp;", " "))), LEADING + "\\s", 1), F.lit(""))
    marks = F.filter(F.transform(paragraphs, lambda p, i: F.struct(marker(p).alias("marker"), i.alias("at"))), lambda m: m["marker"].isNotNull())
    wanted = F.transform(numbers, lambda n: F.regexp_replace(n, "[.)]+$", ""))
    end = lambda i: F.coalesce(F.get(marks, i + 1)["at"], F.size(paragraphs))
    cuts = F.transform(marks, lambda m, i: F.struct(m["marker"].alias("marker"), F.trim(F.array_join(F.slice(paragraphs, m["at"] + 1, end(i) - m["at"]), "\n")).alias("html")))
    whole = F.array(F.struct(F.get(numbers, 0).alias("marker"), html.alias("html")))
    return F.when(F.size(paragraphs) == 0, F.filter(whole, lambda _: F.lit(False))).when(F.size(marks) == 0, whole).otherwise(F.filter(cuts, lambda c: F.array_contains(wanted, c["marker"])))


def answer(text: Column) -> Column:
    """struct(html, highlights) of an answer: a JSON object's fields, else the text as it is; thinking and code fences are left out."""
    from lexstrata.functions.text import without_thinking

    bare = F.trim(F.regexp_replace(without_thinking(some(text)), "(?s)^```(?:json)?\\s*(.*?)\\s*```$", "$1"))
    doc = F.try_parse_json(bare)
    is_object = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    html = F.coalesce(F.try_variant_get(doc, "$.html", "string"), F.lit(""))
    html = F.regexp_replace(F.regexp_replace(html, "  +", " "), ";{2,}", ";")
    return F.struct(F.when(is_object, html).otherwise(bare).alias("html"), F.when(is_object, F.to_json(F.try_variant_get(doc, "$.highlights", "variant"))).alias("highlights"))


def wrapped_tables(html: Column) -> Column:
    """Tables with a border each in a block of their own."""
    return F.regexp_replace(html, "(?is)(<table\\b[^>]*\\bborder=[\"']?1[\"']?[^>]*>.*?</table>)", "<div class=\"table\">$1</div>")


def without_one_space(html: Column) -> Column:
    """The first white-space character of the first text is left out."""
    return F.regexp_replace(html, "(?U)^((?:<[^>]+>)*)\\s", "$1")


def joined_roman(text: Column) -> Column:
    """Roman numbers that spaces part, put together: 'X I V' as 'XIV'."""
    return F.regexp_replace(text, "(?<=\\b[IVXLCDM])\\s+(?=[IVXLCDM]\\b)", "")


def plain(text: Column) -> Column:
    """Entities of spaces as spaces, runs of white space as one, none around a full stop between digits."""
    spaced = F.regexp_replace(F.regexp_replace(some(text), "&nbsp;|&#160;", " "), "(?U)\\s+", " ")
    return F.trim(F.regexp_replace(spaced, "(?<=[0-9]) ?\\. ?(?=[0-9])", "."))


def numbering_kind(number: Column, mark: Column) -> Column:
    """type1 'N.', type2 'N)', type3 'x.', type4 'x)', with _extended for dotted numbers."""
    digits = number.rlike("^[0-9]")
    kind = F.when(digits & (mark == "."), "type1").when(digits, "type2").when(mark == ".", "type3").otherwise("type4")
    return F.concat(kind, F.when(number.contains("."), "_extended").otherwise(""))


def extends(parent: Column, child: Column) -> Column:
    """Whether a child's number goes on from its parent's: '5.1' from '5'."""
    base = F.regexp_replace(parent, "[.)]+$", "")
    return F.startswith(F.regexp_replace(child, "[.)]+$", ""), F.concat(base, F.lit(".")))


def path_of_id(item_id: Column) -> Column:
    """(type, number) of the parts of an id such as '12_article_4_part_1', without a _double_ ending."""
    bare = F.regexp_replace(item_id, "_double_[0-9]+$", "")
    kinds = "section|chapter|article|part|subpoint|point|preamble|nested_appendix|appendix|structured_table|paragraph"
    pattern = F.lit(f"_({kinds})((?:_(?!(?:{kinds})(?:_|$))[^_]+)*)")
    types, numbers = (F.regexp_extract_all(bare, pattern, k) for k in (1, 2))
    return F.zip_with(types, numbers, lambda t, n: F.struct(t.alias("type"), F.nullif(F.replace(F.substring(n, 2, 1000), F.lit("_"), F.lit(".")), F.lit("")).alias("number")))
