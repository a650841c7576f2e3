"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items are turned into template words: numbers, names (words with a capital letter inside a sentence) and
units after a number become typed placeholders ('1,500', '2.5' and 'Mary Ann' are one each), all other words are lower-cased. Windows of ``WINDOW`` template words are hashed, and those
of the texts are joined with those of the items. Windows that lie at one distance from an item's are one alignment; it counts when
its windows cover ``MIN_COVER`` of the item's, or ``LONG_RUN`` words. Alignments of one text and item that lie within ``SHIFT_GAP`` words of
each other, as words put in or taken out leave them, count together when they cover as many words as one with ``MIN_COVER`` does. Then the
names in matched windows are compared: of their places, more than half must have the text's commonest value for the item's, and the other
way round. So a question with other numbers or names is found, while one whose names contradict each other is not, unless its
plain words are enough. Numbers and units may differ place by place, as equal ones may be so by chance.

Items that have slots, or at most ``WINDOW`` words, are also sought by windows of their plain lower-case words, without slots, so that a
verbatim copy is found whatever it consists of; such alignments need no comparison.

Everything is built-in functions. The item windows are broadcast only if there are at most ``BROADCAST_WINDOWS`` of them, and joined by
shuffle otherwise. Only texts that aligned with an item that has slots are read again for the slot values.

Defined cases: null and empty texts match nothing. An item shorter than a window is one window of its own length; an
item without ``MIN_LITERALS`` words outside slots (or, if shorter, all its words) in any window matches verbatim only. Rows with the same doc_id and text count as one.
Repeated items are reported by their own ids. Of several alignments of a text with an item the one with most windows counts, then the
earliest. Other columns are ignored by ``find_leaks`` and pass through the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeloom.llm.common import keep, load, query

WINDOW, MIN_LITERALS, MIN_COVER, LONG_RUN = 8, 5, 0.5, 20
#: Alignments this many words apart at most may be one item with words put in or taken out.
SHIFT_GAP = 4
#: At about 40 bytes each, some 40 MB: below it the item windows are sent to every executor.
BROADCAST_WINDOWS = 1_000_000

#: Units that make a slot when they follow a number.
UNITS = ("mm cm m km in ft yd mi mg g kg lb lbs oz t ml l s sec secs ms min mins h hr hrs hour hours day days week weeks month months year years "
         "usd eur gbp dollar dollars cent cents euro euros percent mph kmh kwh kw w v a hz").split()

#: Marks of the slots: private-use characters.
NUMBER, NAME, UNIT = "", "", ""
#: Stands between the parts of a number or a name of several words.
JOIN = ""
_SEPARATOR = rf"[^\p{{L}}\p{{Nd}}{NUMBER}-{UNIT}{JOIN}]+"
_ALONE = rf"(?<![\p{{L}}\p{{Nd}}{NUMBER}-{UNIT}{JOIN}])(\p{{Nd}}[\p{{Nd}}{JOIN}]*)"


def tagged(text: Column) -> Column:
    """The text with a mark before each slot value; such marks in the text itself are taken out first."""
    t = F.translate(text, NUMBER + NAME + UNIT + JOIN, "    ")
    t = F.regexp_replace(t, r"(?<=[\p{Ll}\p{Nd},;:] )(\p{Lu}[\p{L}\p{Nd}]*)", NAME + "$1")
    t = F.regexp_replace(t, rf" {NAME}(?<={NAME}[\p{{L}}\p{{Nd}}]{{1,40}} {NAME})", JOIN)
    digits = F.regexp_replace(t, r"[.,'’  ](?<=\p{Nd}.)(?=\p{Nd})", JOIN)
    digits = F.regexp_replace(digits, rf"{_ALONE} ?((?i:{'|'.join(UNITS)}))(?![\p{{L}}\p{{Nd}}{JOIN}])", f"{NUMBER}$1 {UNIT}$2")
    digits = F.regexp_replace(digits, _ALONE + rf"(?![\p{{L}}\p{{Nd}}{JOIN}])", NUMBER + "$1")
    return F.when(t.rlike(r"\p{Nd}"), digits).otherwise(t)


def tagged_words(text: Column) -> Column:
    """Words of a text; slot values carry their mark."""
    return F.filter(F.split(tagged(text), _SEPARATOR), lambda w: w != "")


def template_words(words: Column) -> Column:
    first = lambda w: F.substring(w, 1, 1)
    return F.transform(words, lambda w: F.when(first(w).between(NUMBER, UNIT), first(w)).otherwise(F.lower(w)))


def template_of(text: Column) -> Column:
    """Template words straight from the text: the same words as ``template_words(tagged_words(text))``, without a step for each word."""
    t = F.regexp_replace(tagged(text), rf"([{NUMBER}-{UNIT}])[\p{{L}}\p{{Nd}}{JOIN}]+", "$1")
    return F.filter(F.split(F.lower(t), _SEPARATOR), lambda w: w != "")


def plain_words(text: Column) -> Column:
    """Lower-case words of a text, without slots."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")


def _hashes(words: Column, size: int, plain: bool = False) -> Column:
    """(h, pos) of each window, in order: its hash, other for plain words, and its place."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.xxhash64(F.lit(-size if plain else size), F.slice(words, i, size)).alias("h"), (i - 1).alias("pos")))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, text_key, size, n_words, n_windows, slots, plain, item_pos, h): windows of enough words outside slots, and plain ones."""
    is_slot = lambda w: F.substring(w, 1, 1).between(NUMBER, UNIT)
    worded = items.where("text IS NOT NULL").select("item_id", tagged_words(F.col("text")).alias("tags"), plain_words(F.col("text")).alias("_plain")).where(F.size("tags") > 0)
    worded = worded.distinct().withColumns({"text_key": F.xxhash64("tags"), "slots": F.exists("tags", is_slot)})
    typed = worded.select("item_id", "text_key", "slots", F.lit(False).alias("plain"), template_words(F.col("tags")).alias("words"))
    verbatim = worded.where(F.col("slots") | (F.size("tags") <= WINDOW)).select("item_id", "text_key", F.lit(False).alias("slots"), F.lit(True).alias("plain"), F.col("_plain").alias("words"))
    rows = typed.unionByName(verbatim).withColumn("size", F.least(F.lit(WINDOW), F.size("words")))
    # One hash expression for each length that occurs: 1 to WINDOW.
    hashes = F.coalesce(*[F.when((F.col("size") == n) & (F.col("plain") == p), _hashes(F.col("words"), n, p)) for n in range(1, WINDOW + 1) for p in (False, True)])
    literal = lambda i: F.size(F.filter(F.slice("words", i + 1, F.col("size")), lambda w: ~w.between(NUMBER, UNIT)))
    fit = F.filter(F.transform(hashes, lambda w: F.struct(w["pos"].alias("item_pos"), w["h"].alias("h"), literal(w["pos"]).alias("literal"))),
                   lambda w: F.col("plain") | (w["literal"] >= F.least(F.lit(MIN_LITERALS), F.col("size"))))
    rows = rows.select("item_id", "text_key", "size", F.size("words").alias("n_words"), "slots", "plain", fit.alias("fit"))
    return rows.select("item_id", "text_key", "size", "n_words", F.size("fit").alias("n_windows"), "slots", "plain", F.explode("fit").alias("w")).select(
        "item_id", "text_key", "size", "n_words", "n_windows", "slots", "plain", "w.item_pos", "w.h")


def _slots(side: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, place, value) of the slots of tagged words."""
    at = F.filter(F.transform("tags", lambda w, i: F.struct(i.alias("place"), F.lower(w).alias(name))),
                  lambda s: F.substring(s[name], 1, 1).between(NUMBER, UNIT))
    return side.select(*keys, F.explode(at).alias("s")).select(*keys, "s.place", f"s.{name}")


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, cover, changed): texts that hold an item, and whether slot values differ."""
    found = _aligned(docs, items)
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_windows", "cover", "changed")).alias("best")).select(
        "doc_id", "item_id", "best.n_windows", "best.cover", "best.changed")


def _candidates(hits: DataFrame) -> DataFrame:
    """Alignments that cover enough, alone (one part) or a few words apart: shift (the least), hit, cover, and parts of (shift, places)."""
    owner = ["doc_id", "text_key", "item_id", "item_key", "size", "n_words", "n_windows", "slots", "plain"]
    parts = hits.groupBy(*owner, (F.col("doc_pos") - F.col("item_pos")).alias("shift")).agg(F.array_sort(F.collect_set("item_pos")).alias("places"))
    hit = F.size("places")
    parts = keep(parts.withColumn("enough", (hit / F.col("n_windows") >= MIN_COVER) | (hit + F.col("size") - 1 >= LONG_RUN)), "parts")
    single = parts.where("enough").select(*owner, "shift", F.array(F.struct("shift", "places")).alias("parts"), hit.alias("hit"))
    order = Window.partitionBy(*owner).orderBy("shift")
    opens = F.coalesce((F.col("shift") - F.lag("shift").over(order) > SHIFT_GAP).cast("int"), F.lit(1))
    near = parts.withColumn("opens", opens).withColumn("near", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    several = near.groupBy(*owner, "near").agg(
        F.min("shift").alias("shift"), F.collect_list(F.struct("shift", "places")).alias("parts"), F.max("enough").alias("enough"))
    several = several.where(~F.col("enough") & (F.size("parts") > 1)).withColumn("_all", F.array_sort(F.array_distinct(F.flatten("parts.places"))))
    reach = F.transform("_all", lambda p, i: F.least(F.col("size"), F.coalesce(F.get("_all", i + 1) - p, F.col("size"))))
    words = F.aggregate(reach, F.lit(0), lambda n, x: n + x)
    several = several.where(words >= MIN_COVER * F.col("n_windows") + F.col("size") - 1).select(*owner, "shift", "parts", F.size("_all").alias("hit"))
    return keep(single.unionByName(several).withColumn("cover", F.col("hit") / F.col("n_windows")), "alignments")


def _aligned(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, cover, changed), for each text and item."""
    windows = keep(item_windows(items.select("item_id", "text")), "item_windows")
    sizes = sorted((r["plain"], r["size"]) for r in windows.select("plain", "size").distinct().collect())  # at most 2 * WINDOW
    few = windows.count() <= BROADCAST_WINDOWS
    ready = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_key"), template_of(F.col("text")).alias("words"), plain_words(F.col("text")).alias("plain"))
    hashes = [_hashes(F.col("plain" if p else "words"), n, p) for p, n in sizes]
    # Windows go through the join as hash and place only; a row takes no words along.
    rows = ready.select("doc_id", "text_key", F.explode(F.concat(*hashes) if hashes else F.expr("array_repeat(struct(0L AS h, 0 AS pos), 0)")).alias("w"))
    rows = rows.select("doc_id", "text_key", "w.h", F.col("w.pos").alias("doc_pos"))
    right = windows.withColumnRenamed("text_key", "item_key")
    hits = rows.join(F.broadcast(right) if few else right, "h")
    lines = _candidates(hits)
    # Slots: only of texts that aligned with an item that has some.
    slotted = lines.where("slots")
    texts = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    texts = texts.where(F.col("text").rlike(r"\p{Nd}|[\p{Ll}\p{Nd},;:] \p{Lu}"))  # no other text has a slot
    near = slotted.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).distinct()
    texts = texts.join(near, texts["doc_id"].eqNullSafe(near["d"]) & (texts["text_key"] == near["k"]), "left_semi").distinct()
    theirs = _slots(texts.select("doc_id", "text_key", tagged_words(F.col("text")).alias("tags")), ["doc_id", "text_key"], "doc_value").withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    own_items = items.where("text IS NOT NULL").select("item_id", tagged_words(F.col("text")).alias("tags")).distinct().withColumn("item_key", F.xxhash64("tags"))
    ours = _slots(own_items, ["item_id", "item_key"], "item_value").withColumnsRenamed({"place": "item_place", "item_id": "i", "item_key": "ik"})
    inside = F.exists("part.places", lambda p: (F.col("item_place") >= p) & (F.col("item_place") < p + F.col("size")))
    asked = slotted.withColumn("part", F.explode("parts")).join(ours, slotted["item_id"].eqNullSafe(ours["i"]) & (slotted["item_key"] == ours["ik"])).where(inside)
    asked = asked.withColumn("place_wanted", F.col("item_place") + F.col("part.shift"))
    pairs = asked.join(theirs, asked["doc_id"].eqNullSafe(theirs["d"]) & (asked["text_key"] == theirs["k"]) & (asked["place_wanted"] == theirs["place"]), "left")
    line = ["doc_id", "text_key", "item_id", "item_key", "shift"]
    counted = pairs.groupBy(*line, "item_value", "doc_value").agg(F.count("*").alias("n"))
    changed = F.max((~F.col("doc_value").eqNullSafe(F.col("item_value"))).cast("int"))
    name = lambda value: F.col(value).startswith(NAME).cast("int")
    by_item = counted.groupBy(*line, "item_value").agg((F.max("n") * name("item_value")).alias("ours"), (F.sum("n") * name("item_value")).alias("names"), changed.alias("changed"))
    by_doc = counted.where("doc_value IS NOT NULL").groupBy(*line, "doc_value").agg((F.max("n") * name("doc_value")).alias("theirs"))
    seen = by_item.select(*line, "ours", F.lit(0).alias("theirs"), "names", "changed").unionByName(
        by_doc.select(*line, F.lit(0).alias("ours"), "theirs", F.lit(0).alias("names"), F.lit(0).alias("changed")))
    slots = seen.groupBy(*line).agg(F.sum("ours").alias("ours"), F.sum("theirs").alias("theirs"), F.sum("names").alias("names"), F.max("changed").alias("changed"))
    slots = slots.withColumn("bad", (F.col("names") > 0) & (2 * F.least("ours", "theirs") <= F.col("names")))
    slots = slots.select(*[F.col(c).alias(f"_{c}") for c in line], "bad", "changed")
    same = [lines[c].eqNullSafe(slots[f"_{c}"]) for c in line]
    judged = lines.join(slots, same[0] & same[1] & same[2] & same[3] & same[4] & ~lines["plain"], "left").where(~F.coalesce("bad", F.lit(False)))
    best = judged.groupBy("doc_id", "text_key", "item_id").agg(
        F.max(F.struct((~F.col("plain")).alias("typed"), (F.size("parts") == 1).alias("single"), F.col("hit").alias("n_windows"), (-F.col("shift")).alias("early"), "cover",
                       (F.coalesce("changed", F.lit(0)) > 0).alias("changed"))).alias("b"))
    return best.select("doc_id", "text_key", "item_id", "b.n_windows", "b.cover", "b.changed")


_WORDS_SQL = r"list_filter(regexp_split_to_array(lower(regexp_replace(t, chr(57345) || '[\p{L}\p{Nd}]+', chr(57345), 'g')), '[^\p{L}\p{Nd}' || chr(57345) || ']+'), lambda x: x <> '')"
_NAMES_SQL = r"regexp_replace(TEXT, '([\p{Ll}\p{Nd},;:] )(\p{Lu}[\p{L}\p{Nd}]*)', '\1' || chr(57345) || '\2', 'g')"
# Names twice: one that ends where the next one's context begins is found by the second pass. The items have no numbers.
_TEXTS_SQL = _NAMES_SQL.replace("TEXT", _NAMES_SQL.replace("TEXT", "text"))
_SQL = f"""
WITH iw AS (SELECT item_id, {_WORDS_SQL} AS w FROM (SELECT item_id, {_TEXTS_SQL} AS t FROM benchmark)),
dw AS (SELECT doc_id, {_WORDS_SQL} AS w FROM (SELECT doc_id, {_TEXTS_SQL} AS t FROM documents)),
i AS (SELECT item_id, len(w) - 7 AS n, p, array_to_string(w[p:p + 7], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 6)) AS p FROM iw)),
d AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 6)) AS p FROM dw)),
a AS (SELECT doc_id, item_id, n, d.p - i.p AS shift, count(*) AS hit FROM d JOIN i USING (g) GROUP BY ALL)
SELECT doc_id, item_id, max(hit) AS n_windows, max(hit / n) AS cover, false AS changed
FROM a WHERE hit / n >= 0.5 OR hit + 7 >= 20 GROUP BY doc_id, item_id
"""


@query("op6_template_leaks", _SQL)
def benchmark_leaks(spark, sf_dir):
    """Documents that hold an item of ``benchmark``, verbatim or with other numbers, names and units."""
    return find_leaks(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark"))


def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    leaks = _aligned(docs, load(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__tl_id"), F.col("text_key").alias("__tl_key")).distinct()
    keyed = docs.withColumn("__tl_text", F.xxhash64("text"))
    return keyed.join(leaks, keyed["doc_id"].eqNullSafe(leaks["__tl_id"]) & (keyed["__tl_text"] == leaks["__tl_key"]), "left_anti").select(*docs.columns)
