"""Benchmark decontamination by templates, as column expressions and joins only.

Numbers, names (capitalised words within a sentence) and units after numbers become typed
placeholders. Windows of consecutive template words of the benchmark are hash-joined with all
windows of the documents. A document and an item whose common windows cover enough of the item are
looked at once more with the values in the slots, for each place of the document where the item's
windows follow one another: each value of the item must stand for one value of the place wherever
it occurs. Where no place covers enough alone, places whose values agree are taken together. A pair
with such a place is a leak; where the values of the best one differ it is a re-parameterised one.

Defined cases: null and empty texts match nothing; an item of fewer than MIN_WORDS template words
matches nothing; one of fewer than the window's words is matched as a whole; a window with less than
half lexical words is matched with its values only; an item whose other windows touch enough of its
words also leaks where enough of those are found; an item's first word is looked for as a word and as
the name or unit that the text before it would make of it. Repeated items and documents each give their own rows, and
rows that share an id are documents or items of their own, with or without an id. Ties between places go to the one with the most
windows, then an exact one, then the one with more slots. An empty table on either side gives an empty one; other columns are not read.
The join is a broadcast one only while the counted benchmark windows stay below BROADCAST_WINDOWS.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import ascii_lower, free_name, let_through, materialise, without

WINDOW = 8
MIN_WORDS = 5
COVERAGE = 0.5
BROADCAST_WINDOWS = 500_000

SLOT, JOINT = "\x01", "\x02"
#: Words that are units when they follow a number.
UNITS = "km|cm|mm|nm|kg|mg|lb|lbs|oz|ml|mi|ft|in|yd|mph|kmh|hz|khz|mhz|ghz|kb|mb|gb|tb|kw|mw|gw|kwh|usd|eur|gbp|dollars?|euros?|cents?|pounds?|percent|degrees?|metres?|meters?|kilometres?|kilometers?|centimetres?|centimeters?|miles?|feet|foot|inches|inch|yards?|litres?|liters?|grams?|kilograms?|tons?|tonnes?|ounces?|seconds?|minutes?|hours?|days?|weeks?|months?|years?|watts?|volts?|amps?|joules?|newtons?|pascals?|bytes?|bits?"


def template_words(text: Column, values: bool) -> Column:
    """The text's template words; with values, a slot's word has its value after the slot's kind."""
    keep = "$0" if values else ""
    t = F.coalesce(text, F.lit(""))
    t = F.when(F.rlike(t, F.lit("[\x01\x02]")), F.translate(t, SLOT + JOINT, "  ")).otherwise(t)
    t = F.regexp_replace(t, r"(?<=[a-z0-9,;] )[A-Z][a-z]+(?![A-Za-z])", f" {SLOT}m{keep} ")
    numbers = F.regexp_replace(t, r"(?<=[0-9])[.,](?=[0-9])", JOINT)
    numbers = F.regexp_replace(numbers, rf"(?<![A-Za-z0-9{SLOT}{JOINT}])[0-9][0-9{JOINT}]*", f" {SLOT}n{keep} ")
    unit = F.regexp_replace(numbers, rf"(?<={SLOT}n{f'[0-9{JOINT}]{{1,40}}' if values else ''} {{1,2}})(?i:{UNITS})(?![A-Za-z0-9])", f"{SLOT}u{keep} ")
    t = F.when(F.rlike(t, F.lit("[0-9]")), unit).otherwise(t)
    t = F.trim(F.regexp_replace(ascii_lower(t), r"[\x00\x03-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def _joined(size: Column, hashes: Sequence[Column]) -> Column:
    """Hash of a window from its words' hashes; a null one counts as not there."""
    return F.xxhash64(size, *hashes)


def _hashes(words: Column, size: int) -> Column:
    """Hash of each window of size words, in order, from the words' hashes."""
    each = F.transform(words, lambda w: F.xxhash64(w))
    count = F.size(words) - size + 1

    def rolled(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: _joined(F.lit(size), [F.get(own, i + k) for k in range(size)]))

    # one array of word hashes for all windows
    some = F.element_at(F.transform(F.array(each), rolled), 1)
    return F.when(count > 0, some).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, window: int, coverage: float = COVERAGE) -> DataFrame:
    """The items' windows, by the item's row: by template h where half of the words are lexical, else by values too (value_h).

    n_windows counts all windows; n_lexical those by template, null where they touch less of the
    item's words than coverage.
    """
    words = lambda values: template_words(F.col("text"), values=values)
    items = benchmark.select(_row(benchmark, "item_id").alias("item"), "text", words(False).alias("words"), words(True).alias("value_words"))
    items = items.withColumn("size", F.least(F.size("words"), F.lit(window))).where(F.col("size") >= MIN_WORDS)
    items = items.withColumn("n_windows", F.size("words") - F.col("size") + 1)

    def lexical(i: Column) -> Column:
        part = F.slice("words", i, F.col("size"))
        return F.size(F.filter(part, lambda w: ~F.startswith(w, F.lit(SLOT)))) * 2 >= F.col("size")

    items = items.withColumn("lexical", F.filter(F.sequence(F.lit(1), F.col("n_windows")), lexical))
    touched = F.size(F.array_distinct(F.flatten(F.transform("lexical", lambda i: F.sequence(i, i + F.col("size") - 1)))))
    items = items.withColumn("n_lexical", F.when((F.size("lexical") > 0) & (touched >= F.lit(coverage) * F.size("words")), F.size("lexical")))
    # what stands before the item in a document can make a name or a unit of its first word
    word = F.get("words", F.lit(0))
    kinds = F.when(F.rlike(word, F.lit("^[a-z]+$")), F.concat(
        F.when(F.rlike(F.col("text"), F.lit("^[^A-Za-z0-9\x80-\\x{10FFFF}]*[A-Z][a-z]")), F.array(F.lit(""), F.lit("m"))).otherwise(F.array(F.lit(""))),
        F.when(F.rlike(word, F.lit(f"^(?:{UNITS})$")), F.array(F.lit("u"))).otherwise(F.array().cast("array<string>")),
    )).otherwise(F.array(F.lit("")))
    at = items.select("*", kinds.alias("kinds"), F.explode(F.sequence(F.lit(1), F.col("n_windows"))).alias("i"))
    at = at.withColumn("kind", F.explode(F.when(F.col("i") == 1, F.col("kinds")).otherwise(F.array(F.lit("")))))

    def hashed(words: str, first: Column) -> Column:
        part = F.slice(words, F.col("i"), F.col("size"))
        part = F.when(F.col("kind") == "", part).otherwise(F.concat(F.array(first), F.slice(part, 2, F.col("size") - 1)))
        hashes = F.transform(part, lambda w: F.xxhash64(w))
        return _joined(F.col("size"), [F.get(hashes, F.lit(k)) for k in range(window)])

    slot = F.concat(F.lit(SLOT), F.col("kind"))
    return at.select(
        "item", "n_windows", "n_lexical", "size", (F.col("i") - 1).alias("item_pos"),
        hashed("words", slot).alias("h"),
        F.when(~F.array_contains("lexical", F.col("i")), hashed("value_words", F.concat(slot, F.get("value_words", F.lit(0))))).alias("value_h"),
    )


def leaks(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """One row per leaked pair: doc_id, item_id, n_windows, n_matched, coverage, n_slots, reparameterised."""
    return _leaks(documents, benchmark, window, coverage).select(F.col("doc.id").alias("doc_id"), F.col("item.id").alias("item_id"), "n_windows", "n_matched", "coverage", "n_slots", "reparameterised")


def _row(of: DataFrame, id_col: str = "doc_id") -> Column:
    """A row's key, equal for rows of equal id and text only; a null id is like any other."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col("text")).alias("row"))


def _leaks(documents: DataFrame, benchmark: DataFrame, window: int, coverage: float) -> DataFrame:
    documents = documents.select(_row(documents).alias("doc"), "text")
    items = materialise(item_windows(benchmark, window, coverage), "item-windows")
    counted = items.groupBy("size").agg(F.count("*").alias("count"), F.count("value_h").alias("by_value")).collect()  # at most window - MIN_WORDS + 1 rows
    sizes = sorted({r["size"] for r in counted} | {window})
    small = sum(r["count"] for r in counted) <= BROADCAST_WINDOWS

    def windows(values: bool, of: DataFrame, sizes: list[int]) -> DataFrame:
        texts = of.select("doc", template_words(F.col("text"), values=values).alias("words"))
        hashes = F.concat(*[F.transform(_hashes(F.col("words"), s), lambda h, i: F.struct(i.alias("pos"), h.alias("h"))) for s in sizes])
        return texts.select("doc", F.inline(hashes))

    def meet(found: DataFrame, of: DataFrame) -> DataFrame:
        return found.join(F.broadcast(of), "h") if small else let_through(found, "h", of).join(of, "h")  # most windows of the documents go before the shuffle

    hit = ["doc", "item", "n_windows", "n_lexical", "size", "item_pos", "pos"]
    by_value = [r["size"] for r in counted if r["by_value"]]
    if by_value:
        # a template without enough lexical words only tells which documents to read with their values
        dense = items.where(F.col("value_h").isNotNull()).select("h").distinct().withColumn("item", F.lit(None).cast(items.schema["item"].dataType))
        templates = items.where(F.col("value_h").isNull()).select("item", "n_windows", "n_lexical", "size", "item_pos", "h", F.lit(False).alias("dense"))
        both_kinds = templates.unionByName(dense.withColumn("dense", F.lit(True)), allowMissingColumns=True)
        met = meet(windows(False, documents, sizes), both_kinds)
        some = materialise(met.withColumn("pos", F.when(~F.col("dense"), F.col("pos"))).select(*hit, "dense").distinct(), "template-hits")
        dense_docs = materialise(some.where("dense").select("doc").distinct(), "dense-documents")
        readers = let_through(documents, "doc", dense_docs).join(dense_docs, "doc", "left_semi")
        valued = items.where(F.col("value_h").isNotNull()).select("item", "n_windows", "n_lexical", "size", "item_pos", F.col("value_h").alias("h"))
        hits = some.where(~F.col("dense")).select(*hit, F.lit(False).alias("valued")).union(meet(windows(True, readers, sorted(by_value)), valued).select(*hit, F.lit(True)))
    else:
        hits = meet(windows(False, documents, sizes), items).select(*hit, F.lit(False).alias("valued"))
    # a place of the item in the document is where pos - item_pos is the same; units are these places' windows
    units = hits.groupBy("doc", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        *[F.first(c).alias(c) for c in ("n_windows", "n_lexical", "size")], F.array_sort(F.collect_set(F.struct("item_pos", "valued"))).alias("places")
    )
    pairs = units.groupBy("doc", "item").agg(
        *[F.first(c).alias(c) for c in ("n_windows", "n_lexical", "size")], F.array_sort(F.collect_list(F.struct("shift", "places"))).alias("units")
    )
    by_template = lambda places: F.size(F.filter(places, lambda x: ~x["valued"]))
    of_all = lambda places: F.size(places) >= F.lit(coverage) * F.col("n_windows")
    enough = lambda places: of_all(places) | F.coalesce(by_template(places) >= F.lit(coverage) * F.col("n_lexical"), F.lit(False))
    near = materialise(pairs.where(enough(F.array_distinct(F.flatten("units.places")))), "template-pairs")

    near_docs = materialise(near.select("doc").distinct(), "near-documents")
    doc_slots = let_through(documents, "doc", near_docs).join(near_docs, "doc", "left_semi").select("doc", template_words(F.col("text"), values=True).alias("doc_words"))
    item_slots = benchmark.select(_row(benchmark, "item_id").alias("item"), template_words(F.col("text"), values=True).alias("item_words"))
    # pairs are compressed in their table, so that its size says little of what a broadcast of it would take
    both = near.hint("merge").join(doc_slots, "doc").join(item_slots, "item")

    def filled(item_pos: Column, pos: Column) -> Column:
        places = F.sequence(F.lit(0), F.col("size") - 1)
        pair = F.transform(places, lambda k: F.struct(F.get("item_words", item_pos + k).alias("a"), F.get("doc_words", pos + k).alias("b")))
        # the item's first word is of the kind it has in the document
        like = F.transform(pair, lambda x: F.struct(F.when(F.startswith(x["b"], F.lit(SLOT)) & ~F.startswith(x["a"], F.lit(SLOT)), F.concat(F.substring(x["b"], 1, 2), x["a"])).otherwise(x["a"]).alias("a"), x["b"]))
        return F.filter(like, lambda x: F.startswith(x["a"], F.lit(SLOT)))

    def slots_of(at: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(at, lambda x: filled(x["item_pos"], x["pos"]))))

    def single(slots: Column) -> Column:
        return F.size(slots) == F.size(F.array_distinct(F.transform(slots, lambda x: x["a"])))

    # the first place of each window, wherever it is, is one more candidate
    at = F.flatten(F.transform("units", lambda u: F.transform(u["places"], lambda x: F.struct(x.alias("place"), x["item_pos"].alias("item_pos"), (u["shift"] + x["item_pos"]).alias("pos")))))
    first = F.transform(F.array_distinct(F.transform(at, lambda x: x["place"])), lambda i: F.struct(i.alias("place"), i["item_pos"].alias("item_pos"), F.array_min(F.transform(F.filter(at, lambda x: x["place"] == i), lambda x: x["pos"])).alias("pos")))
    by_place = F.transform("units", lambda u: F.struct(u["places"].alias("places"), slots_of(F.transform(u["places"], lambda x: F.struct(x.alias("place"), x["item_pos"].alias("item_pos"), (u["shift"] + x["item_pos"]).alias("pos")))).alias("slots")))
    scattered = F.struct(F.array_sort(F.transform("first", lambda x: x["place"])).alias("places"), slots_of(F.col("first")).alias("slots"))
    # places with the same windows and values are one
    filled_in = both.withColumn("first", first).withColumn("by_place", F.filter(F.array_distinct(by_place), lambda u: single(u["slots"])))
    passes = lambda u: enough(u["places"])

    def join(state: Column, u: Column) -> Column:
        more = F.array_union(state["slots"], u["slots"])
        return F.when(single(more), F.struct(F.array_union(state["places"], u["places"]).alias("places"), more.alias("slots"))).otherwise(state)

    # where no place is enough alone, each takes in the others that agree with it, the largest first
    largest = F.transform(F.array_sort(F.transform("by_place", lambda u: F.struct((-F.size(u["places"])).alias("less"), u["places"].alias("places"), u["slots"].alias("slots")))), lambda u: F.struct(u["places"].alias("places"), u["slots"].alias("slots")))
    alone = filled_in.withColumn("alone", F.filter("by_place", passes)).withColumn("largest", F.when(F.size("alone") == 0, largest))
    joined = F.transform("largest", lambda u: F.aggregate("largest", u, join))
    tried = alone.withColumn("found", F.when(F.size("alone") > 0, F.col("alone")).otherwise(F.filter(F.concat(joined, F.filter(F.array(scattered), lambda u: single(u["slots"]))), passes)))
    whole = lambda u: of_all(u["places"])
    result = F.transform(
        "found",
        lambda u: F.struct(
            F.when(whole(u), F.size(u["places"])).otherwise(by_template(u["places"])).alias("n_matched"),
            (~F.exists(u["slots"], lambda x: x["a"] != x["b"])).alias("same"),
            F.size(u["slots"]).alias("n_slots"),
            F.when(whole(u), F.col("n_windows")).otherwise(F.col("n_lexical")).alias("n_windows"),
        ),
    )
    best = tried.where(F.size("found") > 0).withColumn("best", F.array_max(result))
    return best.select(
        "doc",
        "item",
        F.col("best.n_windows").cast("long").alias("n_windows"),
        F.col("best.n_matched").cast("long").alias("n_matched"),
        (F.col("best.n_matched") / F.col("best.n_windows")).alias("coverage"),
        F.col("best.n_slots").cast("long").alias("n_slots"),
        (~F.col("best.same")).alias("reparameterised"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The documents without the rows that leak an item; their columns as they were."""
    key = free_name(documents.columns, "__doc")
    found = materialise(_leaks(documents, benchmark, window, coverage).select(F.col("doc").alias(key)).distinct(), "leaking")
    return without(documents.withColumn(key, _row(documents)), key, found).select(documents.columns)
