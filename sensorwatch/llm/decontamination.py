"""Benchmark decontamination by template canonicalisation.

A question is leaked even when its numbers, names and units were changed. So texts are turned into templates: numbers, names (capitalised
words inside a sentence) and units (a unit word after a number) become typed placeholders, all else is lowered and stripped of punctuation.

1. Every run of five template tokens is hashed, on both sides, and the hashes are joined.
2. Slot consistency: where a matched window holds placeholders, the item's values and the document's are paired. An item whose equal values
   meet unequal ones in the document (or the other way round) is no re-parameterised copy: its windows with slots do not count.
3. Values of different places of a document are not mixed: the check is made for each alignment (difference of places in document and item), for
   bands of neighbouring alignments, and for the whole document.
4. A document is contaminated by an item when in one of them the windows that count are at least 75 % of the item's windows.

Only DataFrame operations run here. Each document gives as many rows as it has tokens; the benchmark side is small and Spark broadcasts it
while it is under its own limit, else the join is by shuffle, where rows of a frequent window are spread by skew handling.

Defined cases: null or empty texts, and texts of fewer than five tokens, have no windows: they match nothing. Repeated documents are matched as
often as they are given (results are per id: rows sharing an id count as one document); repeated items with one id count once. Rows with a
null id take no part. A window that an item holds twice counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwatch.llm.common import with_once

WINDOW, PERCENT = 5, 75
#: Places that a text may be shifted by against an item, by words put in or left out, within one alignment.
BAND = 16

#: Unit words that count as units after a number.
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "cl", "l", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour",
    "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "inch", "inches", "foot", "feet", "yard", "yards", "mile",
    "miles", "ounce", "ounces", "pound", "pounds", "meter", "meters", "metre", "metres", "liter", "liters", "litre", "litres", "gram", "grams",
    "degree", "degrees", "percent", "dollar", "dollars", "euro", "euros", "cent", "cents", "mph", "kmh", "kw", "kwh", "w", "v", "hz", "gb", "mb",
)
NUMBER, NAME, UNIT = "<n>", "<p>", "<u>"


#: What stands between words: ASCII, Latin-1, general and ideographic marks and blanks, without U+0001 and U+0002, which mark names and decimals.
BETWEEN = "[\\x00\\x03-\\x2f\\x3a-\\x60\\x7b-\\xa9\\xab-\\xb4\\xb6-\\xb9\\xbb-\\xbf\\u2000-\\u206f\\u3000-\\u303f]+"


def with_template(texts: DataFrame) -> DataFrame:
    """texts (.., text) with `words` and `template`: two texts of equally many tokens with one blank between them."""
    text = F.coalesce("text", F.lit(""))
    # A capital after a sentence's end, a line's end or at the text's start says nothing: such words are lowered.
    # A name is a capitalised word that follows a lower-case word or a comma; it is marked before the case is lost.
    marked = F.regexp_replace(text, r"[ \t](?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{Nd},;][ \t]{1,3})", " \u0001")
    rows = with_once(texts, marked=F.lower(marked)).drop("text")
    rows = with_once(rows, numbers=F.col("marked").rlike(r"\p{Nd}"))
    decimals = F.regexp_replace("marked", r"[.,](?<=\p{Nd}[.,])(?=\p{Nd})", "\u0002")
    marked = F.when(F.col("numbers"), decimals).otherwise(F.col("marked"))
    rows = with_once(rows, words=F.trim(F.regexp_replace(marked, BETWEEN, " "))).drop("marked")
    names = F.when(F.contains("words", F.lit("\u0001")), F.regexp_replace("words", "\u0001[^ ]+", NAME)).otherwise(F.col("words"))
    units = "|".join(UNITS)
    counted = F.regexp_replace(F.regexp_replace(names, "(?<![^ ])\\p{Nd}[^ ]*", NUMBER), f"(?<={NUMBER} )(?:{units})(?![^ ])", UNIT)
    return with_once(rows, template=F.when(F.col("numbers"), counted).otherwise(names)).drop("numbers")


def windows(texts: DataFrame, name: str, extra: str) -> DataFrame:
    """(name, window, at, slots): a row for each window of each text; at: its place; slots: the values of a window with placeholders, else null."""
    rows = with_template(texts.select(name, "text")).where("template <> ''")
    values = F.when(F.contains("template", F.lit("<")), F.split("words", " "))
    rows = with_once(rows, tokens=F.split("template", " "), values=values).drop("words", "template").where(F.size("tokens") >= WINDOW)
    rows = with_once(rows, hashes=F.transform("tokens", lambda x: F.xxhash64(x)))
    # Slots are read before the rows are made, so that a row carries its own window only.
    window = lambda k: F.struct(F.xxhash64(*(F.get("hashes", k + i) for i in range(WINDOW))).alias("window"), k.alias("at"), slot_values(k).alias(extra))
    rows = rows.select(name, F.explode(F.transform(F.sequence(F.lit(0), F.size("tokens") - WINDOW), window)).alias("w"))
    return rows.select(name, "w.window", "w.at", f"w.{extra}")


def slot_values(spot: Column) -> Column:
    """type=value of each placeholder of the window at spot, in order; null without any."""
    token = lambda i: F.get("tokens", spot + i)
    marked = [token(i).isin(NUMBER, NAME, UNIT) for i in range(WINDOW)]
    each = [F.when(m, F.concat(token(i), F.lit("="), F.get("values", spot + i))) for i, m in enumerate(marked)]
    some = marked[0] | marked[1] | marked[2] | marked[3] | marked[4]
    return F.when(F.col("values").isNotNull() & some, F.array_compact(F.array(*each)))


def alignments(shift: Column) -> Column:
    """(width, band) of each alignment that a shift of places belongs to: its own, both bands of BAND places, and the whole document (width 0)."""
    one = lambda width, band: F.struct(F.lit(width).alias("width"), band.cast("int").alias("band"))
    half = BAND // 2
    return F.array(one(0, F.lit(0)), one(1, shift), one(BAND, F.floor(shift / BAND) * BAND), one(BAND, F.floor((shift + half) / BAND) * BAND - half))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_found, n_slots, consistent, reparameterised of each contaminated document and its items."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).dropDuplicates()
    items = windows(items, "item_id", "item_slots")
    items = items.groupBy("item_id", "window", F.col("at").alias("item_at")).agg(F.min("item_slots").alias("item_slots"))
    size = items.groupBy("item_id").agg(F.countDistinct("window").alias("n_windows"))
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = windows(texts, "doc_id", "slots")
    hits = found.join(items, "window").withColumn("shift", F.col("at") - F.col("item_at"))
    hits = hits.select("doc_id", "item_id", "window", "item_at", "at", "item_slots", "slots", F.explode(alignments(F.col("shift"))).alias("along"))
    # One place of a window in each alignment; over the whole document, its smallest values.
    place = F.min(F.struct("item_at", "at", "item_slots", "slots"))
    hits = hits.groupBy("doc_id", "item_id", "along", "window").agg(place.alias("place"), F.min("item_slots").alias("item_least"), F.min("slots").alias("least"))
    whole = F.col("along.width") == 0
    values = {"item_slots": F.when(whole, F.col("item_least")).otherwise(F.col("place.item_slots")), "slots": F.when(whole, F.col("least")).otherwise(F.col("place.slots"))}
    hits = hits.withColumns(values)
    # The pairs of values of a document and an item: a function both ways when they are consistent.
    pairs = F.flatten(F.collect_set(F.zip_with("item_slots", "slots", lambda i, d: F.struct(i.alias("i"), d.alias("d")))))
    per = hits.groupBy("doc_id", "item_id", "along").agg(
        F.count("*").alias("n_all"), F.count(F.when(F.col("item_slots").isNull(), 1)).alias("n_plain"), F.array_distinct(pairs).alias("pairs")
    )
    one_way = lambda field: F.size(F.array_distinct(F.transform("pairs", lambda x: x[field])))
    per = per.withColumns({"n_slots": F.size("pairs"), "consistent": (one_way("i") == F.size("pairs")) & (one_way("d") == F.size("pairs"))})
    per = per.withColumn("n_found", F.when(F.col("consistent"), F.col("n_all")).otherwise(F.col("n_plain")))
    per = per.join(size, "item_id").where(F.col("n_found") * 100 >= F.col("n_windows") * percent)
    # The alignment that finds most windows speaks for the document; of equal ones the widest.
    best = F.max_by(F.struct("n_windows", "n_found", "n_slots", "consistent", "pairs"), F.struct("n_found", "consistent", whole, "along"))
    per = per.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
    changed = F.exists("pairs", lambda x: x["i"] != x["d"])
    return per.select("doc_id", "item_id", "n_windows", "n_found", "n_slots", "consistent", (F.col("consistent") & changed).alias("reparameterised"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the contaminated documents."""
    found = contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(found, docs[id_col].cast("long") == F.col("_leak"), "left_anti")
