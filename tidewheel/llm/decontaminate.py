"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become templates: words in lower case, with typed placeholders for numbers, names (capitalised words) and units. Every
window of `WIDTH` template tokens is hashed, from the hashes of its tokens. As a copy in lower or upper case has no names to
tell, windows that hold a name are hashed a second time with its lower-cased words. Windows of documents
meet windows of the benchmark in a hash join; the benchmark side is broadcast behind a check of its size. An item of SHORT to
WIDTH words is one window of its own length; an item of fewer words is met by documents that consist of it alone, as so few
words prove nothing inside a text. Which rule holds depends on the item itself only. Documents with a
shared window are read once more for the evidence: matched windows are lined up with the item by their offset, and the names
in the slots must agree: half of them at least must stand for one name of the item, and the other way round, as when a
question is asked again with other names. Numbers and units are free, as small ones are often equal by chance. Where names
don't agree, only windows of the same words count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import Scratch, fits, table

#: Template tokens of a window and how many of them must be plain words (in a shorter one of lower-cased words, half of them).
WIDTH, PLAIN = 8, 4
#: Items of fewer words only meet whole documents.
SHORT = 4
#: Share of an item's windows that a document must hold to count as contaminated.
COVERAGE = 0.3
#: Share of the names in matched windows that must stand for one name each.
AGREE = 0.5
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
#: Units that are replaced after a number (fixed values).
UNITS = (
    "mm", "cm", "dm", "m", "km", "in", "inch", "inches", "ft", "foot", "feet", "yd", "yard", "yards", "mi", "mile", "miles",
    "mg", "g", "kg", "t", "ton", "tons", "oz", "ounce", "ounces", "lb", "lbs", "pound", "pounds", "ml", "cl", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups",
    "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hr", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "c", "f", "k", "degree", "degrees", "percent", "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur", "gbp", "mph", "kmh", "w", "kw", "v", "a", "hz", "khz", "mhz", "b", "kb", "mb", "gb", "tb",
)


def words(text: Column) -> Column:
    """Words of a text as they stand: runs of letters, digits and what is between digits."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{M}\p{N}]+", " ")
    return F.filter(F.split(F.trim(spaced), " "), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row; plain reuse of a column copies its expression into every place."""
    return F.transform(F.array(value), body)[0]


def lower_or_name(token: Column) -> Column:
    """A word in lower case; a capitalised one (not all in capitals) is a name."""
    first = F.substring(token, 1, 1)
    return F.when(F.lower(token) == token, token).when((F.upper(token) != token) & (F.lower(first) != first), NAME).otherwise(F.lower(token))


def with_numbers(raw: Column) -> Column:
    """Template tokens of a text with digits; a unit right after a number is a placeholder too."""
    typed = F.transform(raw, lambda t: F.when(F.substring(t, 1, 1).between("0", "9"), NUMBER).otherwise(lower_or_name(t)))
    return let(typed, lambda known: F.transform(known, lambda t, k: F.when(t.isin(*UNITS) & (k > 0) & (F.get(known, k - 1) == NUMBER), UNIT).otherwise(t)))


def template(raw: Column) -> Column:
    """Words to template tokens; the steps for numbers only where a word begins with a digit."""
    return F.when(F.exists(raw, lambda t: F.substring(t, 1, 1).between("0", "9")), with_numbers(raw)).otherwise(F.transform(raw, lower_or_name))


def spelled(raw: Column, tokens: Column) -> Column:
    """Template tokens with the names as words in lower case; a unit after a number stays a placeholder."""

    def one(t: Column, k: Column) -> Column:
        word = F.lower(F.get(raw, k))
        return F.when(t != NAME, t).when(word.isin(*UNITS) & (k > 0) & (F.get(tokens, k - 1) == NUMBER), UNIT).otherwise(word)

    return F.when(F.array_contains(tokens, NAME), F.transform(tokens, one)).otherwise(tokens)


def window_hashes(tokens: Column, width: int) -> Column:
    """Hash of every window of `width` tokens, in order; empty for shorter texts."""

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(width), F.greatest(F.size(h) - (width - 1), F.lit(0))), lambda last, k: F.xxhash64(*(F.get(h, k + j) for j in range(width - 1)), last))

    return let(F.transform(tokens, lambda t: F.xxhash64(t)), windows)


def meets(n: Column, width: int) -> Column:
    """Whether a text of n words has windows of this width that count."""
    return n >= width if width >= SHORT else n == width


def all_hashes(raw: Column, widths: list[int]) -> Column:
    """Array of struct(at, width, key): windows of the template, and of the lower-cased words where those differ."""

    def of(tokens: Column, width: int) -> Column:
        numbered = lambda hashes: F.transform(hashes, lambda h, k: F.struct(k.alias("at"), F.lit(width).alias("width"), h.alias("key")))
        named = lambda hashes: F.filter(numbered(window_hashes(spelled(raw, tokens), width)), lambda s: s["key"] != F.get(hashes, s["at"]))
        found = let(window_hashes(tokens, width), lambda hashes: F.when(F.array_contains(tokens, NAME), F.concat(numbered(hashes), named(hashes))).otherwise(numbered(hashes)))
        return F.when(meets(F.size(raw), width), found).otherwise(F.array().cast("array<struct<at:int,width:int,key:bigint>>"))

    return let(template(raw), lambda tokens: F.concat(*(of(tokens, width) for width in widths)))


def plain_enough(window: Column, width: Column, exact: Column) -> Column:
    least = F.when(exact, F.least(F.lit(PLAIN), F.greatest(F.lit(1), F.floor(width / 2)))).otherwise(PLAIN)
    return F.size(F.filter(window, lambda t: ~t.isin(NUMBER, NAME, UNIT))) >= least


def word_keys(raw: Column, at: Column, width: Column) -> Column:
    """Hashes of the lower-cased words of a window: what the evidence needs of them, in 8 bytes each."""
    return F.transform(F.slice(raw, at + 1, width), lambda w: F.xxhash64(F.lower(w)))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, at, width, exact, window, words, named) of the benchmark; exact: of lower-cased words; named: which words are names.

    Windows of mostly placeholders tell nothing and are left out.
    """
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("raw")).where("item_id is not null and size(raw) > 0")
    own = own.withColumn("tokens", template(F.col("raw"))).withColumn("width", F.least(F.size("raw"), F.lit(WIDTH)))
    kinds = F.array(F.struct(F.lit(False).alias("exact"), F.col("tokens").alias("shown")), F.struct(F.lit(True).alias("exact"), spelled(F.col("raw"), F.col("tokens")).alias("shown")))
    hashes = F.coalesce(*(F.when(F.col("width") == w, window_hashes(F.col("kind.shown"), w)) for w in range(1, WIDTH + 1)))
    cut = lambda name: F.slice(name, F.col("at") + 1, F.col("width"))
    return (
        own.select("item_id", "raw", "tokens", "width", F.explode(kinds).alias("kind"))
        .select("item_id", "raw", "tokens", "width", "kind.exact", "kind.shown", F.posexplode(hashes).alias("at", "window"))
        .where(plain_enough(cut("shown"), F.col("width"), F.col("exact")))
        .select("item_id", "at", "width", "exact", "window", word_keys(F.col("raw"), F.col("at"), F.col("width")).alias("words"), F.transform(cut("tokens"), lambda t: t == NAME).alias("named"))
        .dropDuplicates(["item_id", "at", "exact", "window"])
    )


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents with the benchmark item that they hold: doc_id, contaminated boolean, item_id long, coverage double, n_items long.

    One row for each row of docs. item_id is the item of the highest coverage (then the smallest), null where no window
    matches. Items without words match nothing, repeated item rows count once. Null and empty texts and rows without doc_id
    are clean. Rows that repeat a doc_id share the evidence of all of them. Columns besides doc_id and text (docs), item_id
    and text (benchmark) are not read. An empty benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    items = scratch.hold(item_windows(benchmark), "items")
    widths = sorted(r.width for r in items.select("width").distinct().collect()) or [WIDTH]  # at most WIDTH numbers
    keys = items.select(F.col("window").alias("key")).distinct()
    looked_up, side_fits = fits(keys), fits(items, most=4 << 20)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).where("doc_id is not null")
    seen = own.select("doc_id", F.explode(let(words(F.col("text")), lambda raw: all_hashes(raw, widths))).alias("window")).select("doc_id", "window.key")
    touched = scratch.hold(seen.join(F.broadcast(keys) if looked_up else keys, "key").select("doc_id").distinct(), "touched")
    again = F.broadcast(touched) if fits(touched) else touched
    found = own.join(again, "doc_id", "left_semi")
    detail = found.select("doc_id", words(F.col("text")).alias("raw")).select("doc_id", "raw", F.explode(all_hashes(F.col("raw"), widths)).alias("window")).select("doc_id", "raw", "window.*")
    places = detail.join(F.broadcast(keys) if looked_up else keys, "key", "left_semi").select("doc_id", F.col("at").alias("doc_at"), F.col("width").alias("doc_width"), "key", word_keys(F.col("raw"), F.col("at"), F.col("width")).alias("doc_words"))
    side = items.select("item_id", "at", "width", "exact", "window", "words", "named")
    matched = places.join(F.broadcast(side) if side_fits else side, (F.col("key") == F.col("window")) & (F.col("doc_width") == F.col("width")))
    pairs = F.filter(F.arrays_zip("named", "words", "doc_words"), lambda z: z["named"])
    slots = F.transform(pairs, lambda z: F.struct(z["words"].alias("theirs"), z["doc_words"].alias("ours")))
    spots = F.filter(F.transform("named", lambda n, k: F.when(n, F.col("at") + k)), lambda k: k.isNotNull())
    same = F.col("words") == F.col("doc_words")
    matched = scratch.hold(matched.select("doc_id", "item_id", "at", "exact", (F.col("doc_at") - F.col("at")).alias("shift"), same.alias("same"), F.arrays_zip(spots.alias("place"), slots.alias("slot")).alias("slots")), "matched")

    slots = matched.select("doc_id", "item_id", "shift", F.explode("slots").alias("s"))
    key = ["doc_id", "item_id", "shift"]
    slots = slots.select(*key, "s.place", "s.slot.theirs", "s.slot.ours").distinct()
    pairs = slots.groupBy(*key, "theirs", "ours").agg(F.count("*").alias("n"))
    most = [2 * F.col("n") > F.sum("n").over(Window.partitionBy(*key, side)) for side in ("theirs", "ours")]
    agree = F.sum(F.when(F.col("sound"), F.col("n")).otherwise(0))
    split = pairs.withColumn("sound", most[0] & most[1]).groupBy(*key).agg(agree.alias("agree"), F.sum("n").alias("names")).where(F.col("agree") < AGREE * F.col("names")).select(*key, F.lit(True).alias("split"))
    # a place counts for the template if its template tells something, however it matched, and for the words if they are the same
    plain = F.count_distinct(F.when(~F.col("exact"), F.col("at")))
    total = items.groupBy("item_id").agg(plain.alias("of_template"), F.count_distinct(F.when(F.col("exact"), F.col("at"))).alias("of_words"))
    sound = matched.join(split, key, "left").where(F.col("split").isNull() | F.col("same"))
    telling = items.where("not exact").select("item_id", "at", F.lit(True).alias("telling")).distinct()
    sound = sound.select("doc_id", "item_id", "at", "exact").join(F.broadcast(telling) if side_fits else telling, ["item_id", "at"], "left")
    hits = sound.groupBy("doc_id", "item_id").agg(F.count_distinct(F.when(F.col("telling"), F.col("at"))).alias("in_template"), F.count_distinct(F.when(F.col("exact"), F.col("at"))).alias("in_words"))
    share = F.greatest(*(F.when(F.col(f"of_{k}") > 0, F.col(f"in_{k}") / F.col(f"of_{k}")).otherwise(0.0) for k in ("template", "words")))
    rated = hits.join(total, "item_id").select("doc_id", "item_id", share.alias("coverage"))
    best = rated.groupBy("doc_id").agg(
        F.max_by("item_id", F.struct("coverage", -F.col("item_id"))).alias("item_id"), F.max("coverage").alias("coverage"), F.count(F.when(F.col("coverage") >= coverage, 1)).alias("n_items")
    )
    best = scratch.hold(best.withColumnRenamed("doc_id", "of"), "best")
    scratch.drop("matched", "touched", "items")
    known = F.broadcast(best) if fits(best) else best
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(known, F.col("doc_id") == F.col("of"), "left").select(
        "doc_id",
        F.coalesce(F.col("coverage") >= coverage, F.lit(False)).alias("contaminated"),
        "item_id",
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
