"""Benchmark decontamination by template windows: questions are found even with new numbers and names.

Only DataFrame functions: the work stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import spare
from spikelens.sources import stage

WINDOW = 5
LEAST_SHARE = 0.5
#: A benchmark of at most so many windows is sent to every executor (16 bytes each); a larger one is shuffled.
BROADCAST_WINDOWS = 2_000_000

# Unit words and signs that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs pound pounds oz ton tons ml cl l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent degree degrees dollar dollars euro euros cent cents meter meters metre metres gram grams kilometer kilometers kilogram kilograms"
).split()

# Marks of typed placeholders, in characters that texts do not hold.
_NAME, _NUMBER = "\x01", "\x02"
_GAPS = rf"(?:[^\p{{L}}\p{{N}}{_NAME}{_NUMBER}.,]|[.,](?!\d)|(?<!\d)[.,])+"


def tokens(text: Column) -> Column:
    """Words of a text in order; a number or a name begins with its mark, the case of other words is dropped.

    A name is a capitalised word that follows a small-lettered word, a number or a comma within a sentence.
    """
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), _NAME + _NUMBER, "")
    named = F.regexp_replace(plain, r"(?<=[\p{Ll}\d,;:] )(?=\p{Lu}\p{Ll})", _NAME)
    marked = F.regexp_replace(named, r"(?<![\p{L}\p{N}.,])(?=\d)", _NUMBER)
    return F.filter(F.split(F.lower(marked), _GAPS), lambda w: w != "")


def template(words: Column) -> Column:
    """A number per word: placeholders for names, numbers and units after numbers, else the word's hash."""
    units = F.array(*map(F.lit, UNITS))

    def slot(word: Column, i: Column) -> Column:
        first = word.substr(F.lit(1), F.lit(1))
        unit = F.when(F.length(word) <= 10, (i > 0) & F.get(words, i - 1).startswith(_NUMBER) & F.array_contains(units, word))
        return F.when(first == _NAME, F.lit(1)).when(first == _NUMBER, F.lit(2)).when(unit, F.lit(3)).otherwise(F.xxhash64(word))

    return F.transform(words, slot)


def windows(codes: Column, size: int) -> Column:
    """(hash, place) of every window of ``size`` template words."""
    places = F.sequence(F.lit(0), F.size(codes) - size)
    each = F.transform(places, lambda i: F.struct(F.xxhash64(*(F.get(codes, i + k) for k in range(size))).alias("key"), i.alias("place")))
    return F.when(F.size(codes) >= size, each)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """``doc_id, item_id, matched, item_windows, n_slots, exact``: documents that hold a benchmark item.

    Items and documents are turned into templates, and their windows joined by hash. A pair counts when
    the document has ``least_share`` of the item's distinct windows along one alignment, and the slots
    agree: one value of the item's slots never stands for two values in the document. ``exact`` tells
    whether all slot values are the item's own. An item shorter than the window is one window of its own
    length; an item without words matches nothing. Null texts have no words, rows with null ids are not
    reported, repeated rows of an id are one document. Either table may be empty.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(item_text)).alias("item_words")).filter(F.col("item_id").isNotNull() & (F.size("item_words") > 0))
    items = items.withColumn("codes", template(F.col("item_words"))).withColumn("size", F.least(F.lit(window), F.size("item_words")))
    short = sorted(r[0] for r in items.select("size").distinct().collect())  # at most `window` numbers
    if not short:
        return items.select(F.lit(0).cast("long").alias("doc_id"), "item_id", *(F.lit(0).cast("long").alias(c) for c in ("matched", "item_windows", "n_slots")), F.lit(True).alias("exact"))
    by_size = F.coalesce(*(F.when(F.col("size") == n, windows(F.col("codes"), n)) for n in short))
    grams = items.select("item_id", "size", F.explode(by_size).alias("w")).select("item_id", "size", F.col("w.key").alias("key"), F.col("w.place").alias("item_place"))
    per_item = grams.groupBy("item_id").agg(F.countDistinct("key").alias("item_windows"))
    wanted = grams.groupBy("key", "size").agg(F.count("*").alias("n"))
    small = wanted.count() <= BROADCAST_WINDOWS
    send = F.broadcast if small else (lambda df: df)

    # Two steps, as the words are looked up by place: they must be a column and not an expression by then.
    worded = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("words"))
    coded = worded.select("doc_id", template(F.col("words")).alias("codes"))
    every = coded.select("doc_id", F.explode(F.concat(*(F.coalesce(_sized(windows(F.col("codes"), n), n), _sized(None, n)) for n in short))).alias("w"))
    hits = every.select("doc_id", F.col("w.key").alias("key"), F.col("w.size").alias("size"), F.col("w.place").alias("place"))
    # Frequent windows are joined by key alone first, so a document brings each of its places once.
    hits = hits.join(send(wanted.select("key", "size")), ["key", "size"], "left_semi")
    found = hits.join(send(grams), ["key", "size"])
    # Alignments lie within a reach of neighbouring offsets; every reach is whole in one of two overlapping cells.
    reach = 4 * window
    cell = F.floor((F.col("place") - F.col("item_place")) / (2 * reach))
    celled = found.select("doc_id", "item_id", F.struct("key", "place", "item_place", "size").alias("p"), F.explode(F.array(cell - 1, cell)).alias("_cell"))
    lined = celled.groupBy("doc_id", "item_id", "_cell").agg(F.collect_set("p").alias("pairs"))
    lined = lined.withColumn("matched", F.size(F.array_distinct(F.transform("pairs", lambda p: p["key"]))))
    likely = lined.join(send(per_item), "item_id").filter(F.col("matched") >= F.lit(least_share) * F.col("item_windows")).drop("matched")
    # Few rows, read twice below: the windows are not to be made twice.
    return _consistent(_aligned(stage(likely, "likely"), least_share, reach), docs, items, text, doc_id)


def _aligned(likely: DataFrame, least_share: float, reach: int) -> DataFrame:
    """``doc_id, item_id, anchor, matched, item_windows, pairs`` of the alignments with enough windows.

    Every exact offset of a window is an anchor, for the windows at most ``reach`` words off it. A place
    in the document stands for one in the item and the other way round: the pair nearest to the anchor's
    offset, so neither a repeated window nor a second copy mixes other slots in.
    """
    offset = lambda p: p["place"] - p["item_place"]
    low = F.col("_cell") * (2 * reach) + reach  # the cell's anchors, whose reach it holds
    inner = F.filter(F.transform("pairs", offset), lambda o: (o >= low) & (o < low + 2 * reach))
    each = likely.select("doc_id", "item_id", "item_windows", "pairs", F.explode(F.array_distinct(inner)).alias("anchor"))
    near = F.filter("pairs", lambda p: F.abs(offset(p) - F.col("anchor")) <= reach)
    each = each.withColumn("pairs", near).filter(F.size(F.array_distinct(F.transform("pairs", lambda p: p["key"]))) >= F.lit(least_share) * F.col("item_windows"))
    group = ["doc_id", "item_id", "item_windows", "anchor"]
    spots = each.repartition("doc_id", "item_id", "anchor").select(*group, F.explode("pairs").alias("p")).select(*group, "p.*")
    spots = _one_to_one(spots, group, ["key", "size"])
    lined = spots.groupBy(group).agg(F.size(F.collect_set("key")).cast("long").alias("matched"), F.collect_list(F.struct("place", "item_place", "size")).alias("pairs"))
    return lined.filter(F.col("matched") >= F.lit(least_share) * F.col("item_windows"))


def _one_to_one(spots: DataFrame, group: list[str], other: list[str]) -> DataFrame:
    """Of the pairs of a place keep the one nearest to the anchor, by place in the document, then in the item."""
    far = F.abs(F.col("place") - F.col("item_place") - F.col("anchor")).alias("far")
    for own, across in (("place", "item_place"), ("item_place", "place")):
        spots = spots.groupBy(*group, own).agg(F.min(F.struct(far, across, *other)).alias("s")).select(*group, own, f"s.{across}", *(f"s.{c}" for c in other))
    return spots


def _sized(found: Column | None, size: int) -> Column:
    kind = "array<struct<key:bigint,place:int,size:int>>"
    if found is None:
        return F.array().cast(kind)
    return F.transform(found, lambda w: F.struct(w["key"].alias("key"), w["place"].alias("place"), F.lit(size).alias("size"))).cast(kind)


def _consistent(likely: DataFrame, docs: DataFrame, items: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Compare the slots of the few pairs left, word by word."""
    group = ["doc_id", "item_id", "anchor", "matched", "item_windows"]
    words = likely.select(*group, F.explode("pairs").alias("p")).select(*group, "p", F.explode(F.sequence(F.lit(0), F.col("p.size") - 1)).alias("k"))
    spots = words.select(*group, (F.col("p.place") + F.col("k")).alias("place"), (F.col("p.item_place") + F.col("k")).alias("item_place"))
    spots = _one_to_one(spots, group, []).withColumnsRenamed({"place": "at", "item_place": "item_at"})
    ids = likely.select(F.col("doc_id").alias("_doc")).distinct()
    # Only the two columns that are needed, so that names of others can't clash.
    texts = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    texts = texts.join(ids, F.col("doc_id") == F.col("_doc"), "left_semi").select("doc_id", tokens(F.col("_text")).alias("words"))
    # Every row of a repeated id is looked at; one whose slots agree is enough.
    texts = texts.withColumn("_copy", F.xxhash64("words")).dropDuplicates(["doc_id", "_copy"])
    filled = spots.join(items.select("item_id", "item_words"), "item_id").select(
        *group, "at", "item_at", F.get("item_words", F.col("item_at")).alias("value")
    )
    filled = filled.withColumn("slot", F.col("value").rlike(f"^[{_NAME}{_NUMBER}]") | F.col("value").isin(UNITS))
    places = filled.groupBy(group).agg(
        F.collect_set(F.when(F.col("slot"), F.struct("value", "at"))).alias("slots")
    )
    seen = places.join(texts, "doc_id").withColumn("slots", F.transform("slots", lambda s: F.struct(s["value"].alias("value"), F.get("words", s["at"]).alias("own"))))
    agree = F.size(F.array_distinct("slots")) == F.size(F.array_distinct(F.transform("slots", lambda s: s["value"])))
    exact = F.forall("slots", lambda s: s["value"].eqNullSafe(s["own"]))
    return (
        seen.withColumn("exact", exact).filter(F.col("exact") | agree)
        .groupBy("doc_id", "item_id")
        .agg(F.max("matched").alias("matched"), F.max("item_windows").alias("item_windows"), F.max(F.size("slots")).cast("long").alias("n_slots"), F.max("exact").alias("exact"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **settings) -> DataFrame:
    """The documents without a benchmark item, all columns and repeated rows kept; null ids are kept."""
    own = spare(docs, "bad")
    bad = find_contamination(docs, benchmark, doc_id=doc_id, **settings).select(F.col("doc_id").alias(own)).distinct()
    return docs.join(bad, F.col(doc_id) == F.col(own), "left_anti")
