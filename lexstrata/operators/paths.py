"""Paths of structural words: read from text, followed down the tree, completed where they end too early.

Item tables have npa_id, item_id, parent_item_id, item_type, item_number and, where the first of several
counts, place (order among siblings). Path tables have path_id, npa_id, tokens (array of struct type,
number). Walks go level by level, all paths at once, until no path goes on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.numbers import clean_number, number_matches, number_tuple
from lexstrata.functions.text import for_search, squeezed
from lexstrata.session import cut

# Stems of type words, in the order they are tried.
STEMS = (("стат", "article"), ("част", "part"), ("подпункт", "subpoint"), ("пункт", "point"), ("абзац", "paragraph"), ("глав", "chapter"), ("раздел", "section"), ("приложен", "appendix"), ("преамбул", "preamble"), ("таблиц", "structured_table"))
# Types that a path may leave out.
TRANSPARENT = ("appendix", "structured_table", "section", "chapter")
CONTAINERS = ("chapter", "section")
# Beginnings of path texts and what a topic must hold for them.
KEYWORDS = (("наименование", "наименовани"), ("преамбул", "преамбул"), ("статья", "стать"))
QUOTES = "«»“”‘’\"'"


def word_type(word: Column) -> Column:
    return reduce(lambda acc, s: F.when(word.contains(s[0]), F.lit(s[1])).otherwise(acc), reversed(STEMS), F.lit(None).cast("string"))


def bare_word(word: Column) -> Column:
    """Without marks and quotes around it."""
    return F.regexp_replace(word, f"[.,;:){QUOTES}]+$|^[{QUOTES}]+", "")


def word_number(bare: Column) -> Column:
    """The number a bare word (in lower case) stands for: digits, dotted digits, one letter, Roman in upper case; else null."""
    return F.when(bare.rlike("^[ivxlcdm]+[⁰¹²³⁴⁵⁶⁷⁸⁹]*$"), F.upper(bare)).when(bare.rlike("^[0-9.]*[0-9][0-9.]*$|^[а-я]$"), bare)


def structural_tokens(text: Column) -> Column:
    """Types and numbers of a path text, outermost first; a type without a number after it has none; other words are skipped."""
    words = F.split(F.lower(squeezed(text)), " ")
    beside = F.zip_with(words, F.slice(words, 2, 1 << 20), lambda w, after: F.struct(word_type(w).alias("type"), after.alias("after")))  # no step looks back at the whole
    typed = F.transform(F.filter(beside, lambda p: p["type"].isNotNull()), lambda p: F.struct(p["type"].alias("type"), bare_word(p["after"]).alias("bare")))
    return F.transform(typed, lambda p: F.struct(p["type"].alias("type"), word_number(p["bare"]).alias("number")))


def paragraph_order(text: Column) -> Column:
    """The paragraph a path names, from digits or an ordinal word."""
    from lexstrata.functions.numbers import ordinal

    low = F.lower(squeezed(text))
    return ordinal(F.nullif(F.regexp_extract(low, "абзац[а-яё]*\\s+([0-9]+|[а-яё]+)", 1), F.lit("")))


def named_addition(text: Column) -> Column:
    """'type number' of something to add as struct(type, number)."""
    return F.get(structural_tokens(text), 0)


NO_NUMBER = "-"


def with_keys(items: DataFrame) -> DataFrame:
    """A row for each number_key an item answers to: its cleaned number, and NO_NUMBER where a wanted one without number fits it (see `number_matches`)."""
    own = F.concat(F.lit("n"), clean_number(F.col("item_number")))
    keys = F.array_compact(F.array(own, F.when(number_matches(F.col("item_type"), F.col("item_number"), F.lit(None).cast("string")), NO_NUMBER)))
    return items.withColumn("number_key", F.explode(keys))


def wanted_key(number: Column) -> Column:
    return F.when(F.coalesce(F.trim(number.cast("string")), F.lit("")) == "", NO_NUMBER).otherwise(F.concat(F.lit("n"), clean_number(number)))


def _matched(items: DataFrame, wanted: DataFrame, inside: str) -> DataFrame:
    w = wanted.select("want_id", inside, "item_type", wanted_key(F.col("item_number")).alias("number_key"))
    keys = [inside, "item_type", "number_key"]
    keyed = with_keys(items.select("item_id", inside, "item_type", "item_number")).withColumn("n_matches", F.count("*").over(Window.partitionBy(*keys)))
    return keyed.join(w, keys).select("want_id", "item_id", "n_matches")  # a wanted has one key, so what it meets is counted where it is met


def matching(kids: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each wanted (want_id, parent_item_id, item_type, item_number) with the children that match it and how many there are."""
    return _matched(kids, wanted, "parent_item_id")


def matching_anywhere(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """As `matching`, over all items of the wanted document (npa_id)."""
    return _matched(items, wanted, "npa_id")


def resolved(items: DataFrame, paths: DataFrame, transparent: tuple[str, ...] = TRANSPARENT) -> DataFrame:
    """path_id, item_id, n_matches: each item that a path leads to.

    A path starts at the roots of its document. An item that matches the next token takes it; one that
    doesn't is passed through if its type is transparent. Matches are joined by parent, type and number; an item below itself is met once.
    """
    below = F.coalesce("parent_item_id", F.lit("")).alias("up")
    nodes = items.select("npa_id", "item_id", below, "item_type", "item_number")
    keyed = cut(with_keys(nodes).select("npa_id", "up", "item_type", "number_key", "item_id"))
    passed = cut(nodes.where(F.col("item_type").isin(*transparent)).select("npa_id", "up", "item_id"))
    n = F.size("tokens")
    at = paths.where(n > 0).select("npa_id", F.lit("").alias("up"), "path_id", "tokens", F.lit(0).alias("used"), F.expr("cast(array() AS array<string>)").alias("above"))
    found = []
    while True:
        token = F.get("tokens", F.col("used"))
        told = at.withColumn("item_type", token["type"]).withColumn("number_key", wanted_key(token["number"]))
        kept = ["npa_id", "item_id", "path_id", "tokens", "used", "above"]
        hit = told.join(keyed, ["npa_id", "up", "item_type", "number_key"]).select(*kept).withColumn("used", F.col("used") + 1)
        through = at.join(passed, ["npa_id", "up"]).select(*kept)
        through = through.join(hit.select("path_id", "item_id", (F.col("used") - 1).alias("used")), ["path_id", "item_id", "used"], "left_anti").select(*kept)
        rows = cut(hit.withColumn("hit", F.lit(True)).unionByName(through.withColumn("hit", F.lit(False))).where("NOT array_contains(above, item_id)"))
        found.append(rows.where((F.col("used") == n) & F.col("hit")).select("path_id", "item_id"))
        at = rows.where(F.col("used") < n).select("npa_id", F.col("item_id").alias("up"), "path_id", "tokens", "used", F.concat("above", F.array("item_id")).alias("above"))
        if at.isEmpty():
            break
    return reduce(DataFrame.unionByName, found).withColumn("n_matches", F.count("*").over(Window.partitionBy("path_id")))


def deepest_ancestors(items: DataFrame, paths: DataFrame, typed: bool = True) -> DataFrame:
    """path_id, item_id, remaining: how far a path goes from the roots, taking the first match at each level, and the tokens left.

    item_id is null where not even the first token matches. Items are met by type and number (see `with_keys`);
    without `typed` by their cleaned number alone. Keys are made once, and a level's rows are written once.
    """
    own = with_keys(items) if typed else items.withColumn("number_key", clean_number(F.col("item_number"))).where("number_key IS NOT NULL")
    kids = cut(own.select(F.col("npa_id").alias("doc"), F.col("parent_item_id").alias("up"), F.col("item_id").alias("child"), F.col("item_type").alias("own_type"), F.col("number_key").alias("own_key"), "place"))
    key = lambda t: wanted_key(t["number"]) if typed else clean_number(t["number"])
    token = F.transform("tokens", lambda t: F.struct(t["type"].alias("type"), key(t).alias("number_key")))
    at = cut(paths.select("path_id", "npa_id", "tokens", token.alias("keys"), F.lit(0).alias("used"), F.lit(None).cast("string").alias("item_id")))
    ended = []
    while not at.isEmpty():
        asked = at.select("path_id", "npa_id", "item_id", F.get("keys", F.col("used")).alias("token"))
        asked = asked.select("path_id", "npa_id", "item_id", F.col("token.type").alias("type"), F.col("token.number_key").alias("number_key")).where("number_key IS NOT NULL")
        same = (F.col("npa_id") == F.col("doc")) & F.col("item_id").eqNullSafe(F.col("up")) & (F.col("number_key") == F.col("own_key"))
        first = asked.join(kids, same & (F.col("type") == F.col("own_type")) if typed else same).groupBy("path_id").agg(F.min_by("child", F.struct("place", "child")).alias("child"))
        both = cut(at.join(first, "path_id", "left"))
        ended.append(both.where("child IS NULL").select("path_id", "item_id", F.slice("tokens", F.col("used") + 1, F.size("tokens")).alias("remaining")))
        at = both.where("child IS NOT NULL").select("path_id", "npa_id", "tokens", "keys", (F.col("used") + 1).alias("used"), F.col("child").alias("item_id"))
    return reduce(DataFrame.unionByName, ended) if ended else at.select("path_id", "item_id", F.col("tokens").alias("remaining"))


def parents_for_additions(items: DataFrame, paths: DataFrame) -> DataFrame:
    """path_id, item_id, deferred: the one item a path leads to, else its deepest ancestor and the tokens that must be created below it."""
    exact = resolved(items, paths).where("n_matches = 1").select("path_id", F.col("item_id").alias("exact"))
    near = deepest_ancestors(items, paths)
    joined = near.join(exact, "path_id", "left")
    return joined.select("path_id", F.coalesce("exact", "item_id").alias("item_id"), F.when(F.col("exact").isNull() & F.col("item_id").isNotNull() & (F.size("remaining") > 0), F.col("remaining")).alias("deferred"))


def created_paths(items: DataFrame, paths: DataFrame, valid_from: Column, modified_by: Column) -> DataFrame:
    """Rows of the elements that paths lack, each once: item_id, parent_item_id, item_type, item_number, mod_type, valid_from, modified_by_id.

    They hang below the deepest ancestor (below the document's number where there is none).
    """
    from lexstrata.functions.numbers import item_number

    near = deepest_ancestors(items, paths).join(paths.select("path_id", "npa_id"), "path_id")
    label = lambda t: F.concat_ws("_", t["type"], F.nullif(F.regexp_replace(F.regexp_replace(F.coalesce(t["number"], F.lit("")), "[.)]+$", ""), "\\.", "_"), F.lit("")))
    rows = near.select("item_id", F.coalesce("item_id", F.col("npa_id").cast("string")).alias("base"), F.transform("remaining", label).alias("labels"), F.posexplode("remaining").alias("k", "token"))
    chain = lambda n: F.concat_ws("_", "base", F.nullif(F.array_join(F.slice("labels", 1, n), "_"), F.lit("")))
    parent = F.when(F.col("k") == 0, F.col("item_id")).otherwise(chain(F.col("k")))
    out = rows.select(chain(F.col("k") + 1).alias("item_id"), parent.alias("parent_item_id"), F.col("token.type").alias("item_type"), item_number(F.col("token.type"), F.col("token.number")).alias("item_number"))
    return out.groupBy("item_id").agg(*[F.first(c).alias(c) for c in out.columns[1:]]).select("*", F.lit("add").alias("mod_type"), valid_from.alias("valid_from"), modified_by.alias("modified_by_id"))


def in_containers(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """want_id, container_id, item_id: where a number stands, or belongs, among the chapters or sections below parent_item_id.

    The container that holds it; else the one that holds its base number ('5' of '5.1'); else the one
    whose greatest number of that type is nearest below it; else the first.
    """
    from lexstrata.operators.bodies import containers

    boxes = items.where(F.col("item_type").isin(*CONTAINERS)).select(F.col("item_id").alias("container_id"), F.col("parent_item_id").alias("above"), F.col("place").alias("box_place"))
    inner = items.join(boxes, F.col("parent_item_id") == F.col("container_id")).select("above", "container_id", "box_place", "item_id", F.col("item_type").alias("kind"), clean_number(F.col("item_number")).alias("number"), number_tuple(F.col("item_number")).alias("tuple"))
    w = wanted.select("want_id", F.col("parent_item_id").alias("above"), F.col("item_type").alias("kind"), F.col("item_number").alias("text"))

    def by_number(rank: int, number: Column, item: Column) -> DataFrame:
        asked = w.withColumn("number", clean_number(number)).where("number IS NOT NULL AND number <> ''")
        return asked.join(inner, ["above", "kind", "number"]).select("want_id", F.lit(rank).alias("rank"), "box_place", "container_id", item.alias("item_id"))

    none = F.lit(None).cast("string")
    base = F.when(F.col("text").contains("."), F.split("text", "\\.")[0])
    tops = inner.groupBy(F.struct("above", "kind").alias("parent_item_id"), "container_id").agg(F.max("tuple").alias("top")).where(F.col("top") != F.array(F.lit(0)))
    below = containers(tops, w.select(F.struct("above", "kind").alias("parent_item_id"), number_tuple(F.col("text")).alias("number")).distinct())
    third = w.withColumn("number", number_tuple(F.col("text"))).join(below.select("parent_item_id.*", "number", "container_id"), ["above", "kind", "number"]).select("want_id", F.lit(3).alias("rank"), F.lit(0).alias("box_place"), "container_id", none.alias("item_id"))
    last = w.join(boxes.groupBy("above").agg(F.min_by("container_id", "box_place").alias("container_id")), "above").select("want_id", F.lit(4).alias("rank"), F.lit(0).alias("box_place"), "container_id", none.alias("item_id"))
    every = by_number(1, F.col("text"), F.col("item_id")).unionByName(by_number(2, base, none)).unionByName(third).unionByName(last)
    return every.groupBy("want_id").agg(F.min_by(F.struct("container_id", "item_id"), F.struct("rank", "box_place", "container_id")).alias("m")).select("want_id", "m.*")


def appendix_by_number(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """want_id, item_id: the first appendix of a document with the wanted number."""
    own = items.where("item_type = 'appendix'").select("npa_id", clean_number(F.col("item_number")).alias("number"), "item_id", "place")
    return wanted.select("want_id", "npa_id", clean_number(F.col("item_number")).alias("number")).join(own, ["npa_id", "number"]).groupBy("want_id").agg(F.min_by("item_id", F.struct("place", "item_id")).alias("item_id"))


def by_numbers(items: DataFrame, paths: DataFrame) -> DataFrame:
    """path_id, item_id of paths that name numbers only (array<string>), each the first child with that number; null where one is missing."""
    steps = paths.select("path_id", "npa_id", F.transform("numbers", lambda x: F.struct(F.lit(None).cast("string").alias("type"), x.alias("number"))).alias("tokens"))
    found = deepest_ancestors(items, steps, typed=False)
    return found.select("path_id", F.when(F.size("remaining") == 0, F.col("item_id")).alias("item_id"))


def changer_ids(found: DataFrame, changes: DataFrame) -> DataFrame:
    """change_id, modified_by_id: ids of the source items of a change, in order, joined by ', '; without a number the source itself.

    found: change_id, pos, item_id; changes: change_id, numbers (array), source_item_id.
    """
    listed = found.where("item_id IS NOT NULL").groupBy("change_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item_id"))), lambda x: x["item_id"]), ", ").alias("ids"))
    named = F.size(F.coalesce("numbers", F.array().cast("array<string>"))) > 0
    return changes.join(listed, "change_id", "left").select("change_id", F.when(named, F.col("ids")).otherwise(F.col("source_item_id")).alias("modified_by_id"))


def topic(html: Column) -> Column:
    """A paragraph's text before its first opening quote, in lower case."""
    return F.lower(F.split(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", ""), "«")[0])


def topic_patterns(text: Column) -> Column:
    """Beginnings of type words and the numbers after them in a path text."""
    stems = "|".join(stem for stem, kind in STEMS if kind not in ("appendix", "preamble", "structured_table"))
    pattern = F.lit(f"(?iu)((?:{stems})[а-яё]*)\\s+«?\\s*([а-яё]|[0-9]+(?:\\.[0-9]+)?)\\s*»?")
    words, numbers = (F.regexp_extract_all(text, pattern, k) for k in (1, 2))
    return F.zip_with(words, numbers, lambda w, n: F.struct(F.substring(F.lower(w), 1, 4).alias("stem"), n.alias("number")))


def keyword(text: Column) -> Column:
    """What a topic must hold if the path text begins with the word of a title, a preamble or an article; else null."""
    low = F.lower(F.trim(text))
    return reduce(lambda acc, k: F.when(low.startswith(k[0]), F.lit(k[1])).otherwise(acc), reversed(KEYWORDS), F.lit(None).cast("string"))


def topic_score(text: Column, patterns: Column) -> Column:
    """How many of the patterns' numbers stand near their word: at most 25 characters after its start, or right before it."""

    def near(p: Column) -> Column:
        number = F.regexp_replace(p["number"], "\\.", "\\\\.")
        end = F.lit("(?![0-9.])")
        gap = F.concat(F.lit(".{0,"), (F.lit(25) - F.length(p["stem"])).cast("string"), F.lit("}"))
        pattern = F.concat(F.lit("(?s)"), p["stem"], gap, number, end, F.lit("|"), number, end, F.lit("."), F.lit("{0,1}"), p["stem"])
        return F.regexp_like(text, pattern)

    return F.size(F.filter(patterns, near))


def narrowed(items: DataFrame, closed: DataFrame, asks: DataFrame) -> DataFrame:
    """want_id, item_id: of an item's descendants that whose topic fits a path text best (of equals the deeper, then the first); none fits: the item.

    items: item_id, html (its first paragraph), preorder; asks: want_id, item_id, text.
    """
    below = closed.select(F.col("ancestor_id").alias("item_id"), F.col("item_id").alias("below"), "distance")
    told = asks.withColumn("patterns", topic_patterns(F.col("text"))).withColumn("keyword", keyword(F.col("text")))
    scored = told.where("size(patterns) > 0 OR keyword IS NOT NULL").join(below, "item_id")
    own = items.select(F.col("item_id").alias("below"), topic(F.col("html")).alias("topic"), "preorder")
    scored = scored.join(own, "below").withColumn("score", topic_score(F.col("topic"), F.col("patterns")) + F.coalesce(F.contains("topic", F.col("keyword")).cast("int"), F.lit(0))).where("score > 0")
    best = scored.groupBy("want_id").agg(F.max_by("below", F.struct("score", "distance", -F.col("preorder"))).alias("best"))
    return asks.join(best, "want_id", "left").select("want_id", F.coalesce("best", "item_id").alias("item_id"))


def target_items(items: DataFrame, targets: DataFrame) -> DataFrame:
    """npa_id, item_id: of each source document the first item whose text (with all below it) names the target.

    items: npa_id, item_id, text, preorder; targets: npa_id, number, doc_type, year. A law is named by its digits
    and its word, a regulation by these and its year.
    """
    words = items.join(targets, "npa_id").withColumn("norm", for_search(F.col("text")))
    digits = F.regexp_replace("number", "[^0-9]", "")
    regulation = F.col("doc_type") == "regulation"
    hit = (digits != "") & F.col("norm").contains(digits) & F.when(regulation, F.col("norm").contains("постановлени") & F.col("norm").contains(F.coalesce(F.col("year").cast("string"), F.lit("")))).otherwise(F.col("norm").contains("закон"))
    return words.where(hit).groupBy("npa_id").agg(F.min_by("item_id", F.struct("preorder", "item_id")).alias("item_id"))


def found_by_id(items: DataFrame, ids: DataFrame) -> DataFrame:
    """The first item, in the order of the document, of each id asked for."""
    return items.join(ids.select("item_id").distinct(), "item_id", "left_semi").groupBy("item_id").agg(F.min_by(F.struct(*[c for c in items.columns if c != "item_id"]), F.col("preorder")).alias("m")).select("item_id", "m.*")


def keys_below(items: DataFrame, closed: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """wanted rows (root_id and keys) whose keys stand somewhere below their root."""
    below = closed.select(F.col("ancestor_id").alias("root_id"), "item_id").join(items.select("item_id", *[F.col(k).alias(f"{k}_below") for k in keys]), "item_id")
    return wanted.join(below.withColumnRenamed("root_id", "root_below"), reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}_below")) for k in keys], F.col("root_id") == F.col("root_below")), "left_semi")
