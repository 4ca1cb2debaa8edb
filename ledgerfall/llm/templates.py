"""Benchmark decontamination by templates: re-parameterised questions are found too.

DataFrame functions only.  Numbers, units and names become typed placeholders; a row of
placeholders without a word among them says too little and keeps its values.  Windows
of template tokens are joined by hash; for a text and an item with enough windows in
common, the aligned tokens are compared and the placeholders' values must map
consistently: a value of the item always to the same value of the text.  Each copy in a
text is judged alone, so that one does not hide another.

A text with the share of an item's windows that is asked for has at least one of any
``n - share * n + 1`` of them.  So only that many of an item's windows, those that fewest
items have, look for candidates, and those that tell a few items; the candidates are
then compared by all windows.  Wording that many items share costs a join only for
items that have hardly any other.

The item windows are a stored table, so Spark knows its size: it is broadcast
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled above.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfall.llm.shared import stored

#: Template tokens in a window, and placeholders in a row that keep their values.
WINDOW = 5
ROW = 4
#: An item is in a text that has this share of its windows, or this many in step (13 tokens in a row) of those that tell it.
COVERAGE = 0.6
IN_STEP = 9
#: Share of placeholders whose value must agree with the commonest mapping of its item value.
CONSISTENT = 0.8
#: Windows that more items than this have are the benchmark's own wording (instructions, answer forms): they tell no item.
COMMON = 20
#: Steps at most this far apart are one copy with insertions or deletions; each of these is tried, and all steps together.
APART = (0, 4, 16, 64)

NUMBER, UNIT, NAME = "\u0001", "\u0002", "\u0003"
# --- Fixed values: units that follow a number
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours "
    "day days week weeks month months year years percent degrees dollars cents euros pounds usd eur gbp mph kmh kb mb gb tb "
    "metre metres meter meters kilometre kilometres kilometer kilometers mile miles foot feet inch inches gram grams "
    "kilogram kilograms litre litres liter liters w kw v a hz"
).split()


#: A capitalised word, with parts after a hyphen, an apostrophe or none (McDonald); or one like O'Neil.
_PART = r"\p{Lu}\p{Ll}+"
NAMES = rf"(?:\p{{Lu}}['’])?{_PART}(?:['’-]?{_PART})*"
MARKS = f"{NUMBER}{UNIT}{NAME}"


def _unmarked(text: Column) -> Column:
    """The text without characters that stand for placeholders."""
    return F.when(text.rlike(f"[{MARKS}]"), F.translate(text, MARKS, "")).otherwise(text)


def template(text: Column) -> Column:
    """Lower-case words without punctuation, numbers, units and names as placeholders.

    A name is a capitalised word inside a sentence.  Tokens without letter or digit
    are none, so that ``values`` has the same positions.
    """
    text = _unmarked(text)
    steps = (
        (rf"(?<=[\p{{Ll}}\p{{N}},;]\s){NAMES}", NAME),
        (r"(?<!\S)[^\p{L}\s\x01-\x03]*\p{N}\S*", NUMBER),
    )
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    text = F.regexp_replace(F.lower(text), rf"(?<=\x01\s)(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", UNIT)
    text = F.regexp_replace(text, r"[^\p{L}\p{N}\s\x01-\x03]+", "")
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda token: token != "")


def values(text: Column) -> Column:
    """The words themselves, at the positions of ``template``."""
    words = F.split(_unmarked(text), r"[\x20\x09-\x0D]+")
    return F.transform(
        F.filter(words, lambda word: word.rlike(r"[\p{L}\p{N}]")),
        lambda word: F.lower(F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")),
    )


def _slot(token: Column) -> Column:
    return token.isin(NUMBER, UNIT, NAME)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _tokens(text: Column) -> Column:
    """The template of a text, values where placeholders stand ``ROW`` or more in a row."""

    def with_rows(tokens: Column) -> Column:
        def in_row(i: Column) -> Column:
            starts = F.sequence(F.greatest(i - (ROW - 1), F.lit(0)), F.least(i, F.size(tokens) - ROW))
            return F.exists(starts, lambda at: F.forall(F.slice(tokens, at + 1, ROW), _slot))

        kept = lambda raw: F.transform(
            tokens, lambda token, i: F.when(_slot(token) & in_row(i), F.get(raw, i)).otherwise(token)
        )
        # Rows are rare: only texts that have one are gone through token by token.
        rows = F.array_join(tokens, " ").rlike(rf"(?:[{MARKS}](?: |$)){{{ROW}}}")
        return F.when(rows, _once(values(text), kept)).otherwise(tokens)

    return _once(template(text), with_rows)


def _with_tokens(df: DataFrame) -> DataFrame:
    return df.withColumn("tokens", _tokens(F.col("text")))


def _windows(tokens: Column, window: int) -> Column:
    """Hashes of the windows in order; of the whole sequence if it is shorter."""
    last = F.size(tokens) - window
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(tokens, i + 1, window)))
    whole = F.array(F.xxhash64(tokens, F.lit("short")))
    return F.when(last >= 0, each).when(F.size(tokens) > 0, whole)


def _items(benchmark: DataFrame) -> DataFrame:
    """A row per class of items that are in the same texts: ``item, class, item_id, item_ids, tokens, raw``.

    ``item`` is a number of the template, ``class`` one of the class, and ``raw`` has the values where placeholders
    stand.  How values map depends on the places that share one, and on nothing else of
    them: so items of one template are one class if the same of their places are equal.
    ``item_ids`` are those of all its items, ``item_id`` is the least.
    """
    at_slots = lambda raw: F.transform("tokens", lambda token, i: F.when(_slot(token), F.get(raw, i)))
    rows = stored(
        _with_tokens(benchmark.select("item_id", "text"))
        .where("size(tokens) > 0")
        .select("item_id", "tokens", _once(values(F.col("text")), at_slots).alias("raw"))
        .groupBy("tokens", "raw")
        .agg(F.collect_set("item_id").alias("ids"))
        .withColumn("n", F.monotonically_increasing_id())
    )
    places = rows.select("n", F.posexplode("raw").alias("q", "value")).where("value IS NOT NULL").groupBy("n", "value")
    equal = places.agg(F.sort_array(F.collect_list("q")).alias("qs")).groupBy("n").agg(F.sort_array(F.collect_list("qs")).alias("equal"))
    return (
        rows.join(equal, "n", "left")
        .groupBy("tokens", "equal")
        .agg(
            F.min("n").alias("n"), F.min("raw").alias("raw"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("item_ids"),
        )
        .select(
            F.min("n").over(Window.partitionBy("tokens")).alias("item"), F.col("n").alias("class"),
            F.get("item_ids", F.lit(0)).alias("item_id"), "item_ids", "tokens", "raw",
        )
    )


def _item_windows(items: DataFrame, window: int, coverage: float) -> DataFrame:
    """``h, item, j, n_windows, telling, anchor``: all windows, whether they tell their items, and look for candidates."""
    each = items.dropDuplicates(["item"]).select("item", F.posexplode(_windows(F.col("tokens"), window)).alias("j", "h"))
    having = each.groupBy("h").agg(F.count_distinct("item").alias("having"))
    item = Window.partitionBy("item")
    n, telling = F.count(F.lit(1)).over(item), F.col("having") <= COMMON
    rank = F.row_number().over(item.orderBy("having", "h", "j"))
    return (
        each.join(having, "h")
        .withColumns({"n_windows": n, "telling": telling, "rank": rank})
        .withColumn("anchor", telling | (F.col("rank") <= F.col("n_windows") - F.floor(coverage * F.col("n_windows")) + 1))
        .select("h", "item", "j", "n_windows", "telling", "anchor")
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    in_step: int = IN_STEP,
    consistent: float = CONSISTENT,
) -> DataFrame:
    """Texts that hold a benchmark item: ``doc_id, text_hash, item_id, item_ids, n_matched, n_windows, n_slots, n_consistent``.

    One row per (row of ``docs`` up to repetition, class of items).  Items of one
    template whose values are equal at the same places are in the same texts: they are a
    class, ``item_id`` is its least id and ``item_ids`` are all of them (``per_item`` has
    a row for each).  Items with null or no words are in no text; an item shorter than a
    window is only in a text that consists of it; null and empty texts hold nothing,
    empty tables give an empty result.  Very long texts are gone through whole.  Rows
    without ``doc_id`` are told by their text, items without ``item_id`` are looked for
    as others are.  Other columns are not read, whatever their names.
    """
    items = stored(_items(benchmark))
    told = stored(_item_windows(items, window, coverage))
    mark = F.xxhash64("text").alias("text_hash")
    row = ["doc_id", "text_hash", "item"]

    def pieces(texts: DataFrame) -> DataFrame:
        # The template is a column of its own, or Spark would work it out again for each window.
        tokens = _with_tokens(texts.select("doc_id", mark, "text")).select("doc_id", "text_hash", "tokens")
        return tokens.select("doc_id", "text_hash", F.posexplode(_windows(F.col("tokens"), window)).alias("i", "h"))

    anchors = told.where("anchor").select("h", "item").distinct()
    pairs = stored(pieces(docs).join(anchors, "h").select(*row).distinct())
    # All windows, of the candidates only.
    texts = pairs.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = docs["doc_id"].eqNullSafe(texts["__id"]) & (F.xxhash64(docs["text"]) == texts["__hash"])
    found = pieces(docs.join(texts, same, "left_semi").select("doc_id", "text").distinct())
    asked = pairs.join(told, "item").withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash", "h": "__h"})
    there = found["doc_id"].eqNullSafe(asked["__id"]) & (found["text_hash"] == asked["__hash"]) & (found["h"] == asked["__h"])
    met = stored(
        found.join(asked, there).select(*row, "j", "n_windows", "telling", (F.col("i") - F.col("j")).alias("step")).distinct()
    )
    steps = met.groupBy(*row, "n_windows", "step").agg(
        F.collect_set("j").alias("js"), F.count_distinct(F.when(F.col("telling"), F.col("j"))).alias("n_telling")
    )
    enough = (F.col("n_matched") >= coverage * F.col("n_windows")) | (F.col("in_step") >= in_step)
    # All steps together have at least what any copy has.
    likely = _measured(steps, [*row, "n_windows"], F.struct("step", "js", "n_telling")).where(enough).drop("in_step", "n_matched")
    copies = _copies(stored(likely), row)
    likely = _measured(copies, [*row, "n_windows", "low", "high"], F.struct("step", "js")).where(enough).drop("in_step")
    held = _with_slots(stored(likely), docs, items, window).where(
        (F.col("n_unequal") == 0) & (F.col("n_consistent") >= consistent * F.col("n_slots"))
    )
    numbers = ["n_matched", "n_windows", "n_slots", "n_consistent"]
    # Of several copies the fullest is reported, of equal ones the most consistent.
    best = F.max(F.struct("n_matched", (F.col("n_consistent") - F.col("n_slots")).alias("fit"), *numbers[1:])).alias("best")
    held = held.groupBy("doc_id", "text_hash", "class").agg(best).join(items.select("class", "item_id", "item_ids"), "class")
    return held.select("doc_id", "text_hash", "item_id", "item_ids", *(F.col(f"best.{name}") for name in numbers))


def per_item(found: DataFrame) -> DataFrame:
    """What ``contaminated`` found with a row per item instead of one per class."""
    ids = F.explode_outer("item_ids").alias("item_id")
    return found.select(*(ids if name == "item_id" else name for name in found.columns if name != "item_ids"))


def _measured(steps: DataFrame, by: list[str], each: Column) -> DataFrame:
    """Per group: most windows in one step that tell the item, different windows, and the steps."""
    return steps.groupBy(*by).agg(
        F.max("n_telling").alias("in_step"),
        F.size(F.array_distinct(F.flatten(F.collect_list("js")))).alias("n_matched"),
        F.collect_list(each).alias("steps"),
    )


def _copies(likely: DataFrame, row: list[str]) -> DataFrame:
    """The steps of each possible copy, told by its least and its largest step."""
    each = likely.select(*row, "n_windows", F.explode("steps").alias("s")).select(*row, "n_windows", "s.step", "s.js", "s.n_telling")
    up, down = (Window.partitionBy(*row).orderBy(F.col("step").asc()), Window.partitionBy(*row).orderBy(F.col("step").desc()))
    step = F.col("step")
    each = each.withColumn("below", step - F.lag("step").over(up)).withColumn("above", F.lead("step").over(up) - step)
    so_far = lambda order: order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounds = []
    for n, apart in enumerate((*APART, None)):
        first, last = F.col("below").isNull(), F.col("above").isNull()
        if apart is not None:
            first, last = first | (F.col("below") > apart), last | (F.col("above") > apart)
        each = each.withColumn(f"low{n}", F.max(F.when(first, step)).over(so_far(up)))
        each = each.withColumn(f"high{n}", F.min(F.when(last, step)).over(so_far(down)))
        bounds.append(F.struct(F.col(f"low{n}").alias("low"), F.col(f"high{n}").alias("high")))
    columns = [*row, "n_windows", "step", "js", "n_telling"]
    return each.select(*columns, F.explode(F.array_distinct(F.array(*bounds))).alias("b")).select(*columns, "b.low", "b.high")


def _with_slots(likely: DataFrame, docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Aligned tokens compared, by class: unequal ones, placeholders, and placeholders that map as most of their value do."""
    copy = ["doc_id", "text_hash", "item", "low", "high"]
    of_class = [*copy, "class", "n_matched", "n_windows"]
    ids = likely.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    held = _with_tokens(
        texts.join(ids, texts["doc_id"].eqNullSafe(ids["__id"]) & (texts["text_hash"] == ids["__hash"]), "left_semi")
    ).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"),
        F.col("tokens").alias("doc_tokens"), values(F.col("text")).alias("doc_raw"),
    ).dropDuplicates(["__id", "__hash"])
    places = (
        likely.select(*copy, "n_matched", "n_windows", F.explode("steps").alias("s"))
        .select(*copy, "n_matched", "n_windows", "s.step", F.explode("s.js").alias("j"))
        .select(*copy, "n_matched", "n_windows", "step", F.explode(F.sequence("j", F.col("j") + window - 1)).alias("q"))
        .distinct()
    )
    aligned = (
        # Exploded, so larger than Spark expects of the table behind it: not to be broadcast.
        places.hint("merge").join(held, places["doc_id"].eqNullSafe(held["__id"]) & (places["text_hash"] == held["__hash"]))
        .join(items.select("item", "class", "tokens", "raw"), "item")
        .where(F.col("q") < F.size("tokens"))
        .select(
            *of_class,
            F.get("tokens", F.col("q")).alias("token"),
            F.get("doc_tokens", F.col("q") + F.col("step")).alias("doc_token"),
            F.get("raw", F.col("q")).alias("value"),
            F.get("doc_raw", F.col("q") + F.col("step")).alias("doc_value"),
        )
    )
    slot = F.col("token").isin(NUMBER, UNIT, NAME)
    value = F.when(slot, F.col("value"))
    pairs = aligned.groupBy(*of_class, value.alias("value"), F.when(slot, F.col("doc_value")).alias("doc_value")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("token").eqNullSafe(F.col("doc_token"))).alias("unequal")
    )
    mapped = pairs.groupBy(*of_class, "value").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("unequal").alias("unequal")
    )
    of_slots = lambda name: F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col(name))), F.lit(0))
    return mapped.groupBy(*of_class).agg(
        of_slots("n").alias("n_slots"), of_slots("most").alias("n_consistent"), F.sum("unequal").alias("n_unequal")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; every repetition of one goes or stays."""
    found = contaminated(docs, benchmark, **parameters).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    ).distinct()
    same = docs["doc_id"].eqNullSafe(found["__id"]) & (F.xxhash64(docs["text"]) == found["__hash"])
    return docs.join(found, same, "left_anti")
