"""Benchmark decontamination by winnowing, with DataFrame functions only.

A text's k-grams of words are hashed, and of every ``span - gram + 1`` consecutive ones the least (of equal ones the last) is kept as a
fingerprint. A span of ``span`` words that a document shares with an item holds exactly that many k-grams, so both keep the same one at the
same place of it: no shared span is missed. The documents' fingerprints are joined with the items', and each hit is extended
word by word to both sides; with ``span`` words or more in agreement, all of them are hit. Words are compared by 64-bit hashes, so a
false window of ten words takes an agreement on 192 bits, and one of an item of eight words or fewer on 64.

An item of fewer words than ``span`` is a window as a whole: its length is a level of its own, with k-grams no longer than the
item, and documents are fingerprinted once for each level that the benchmark holds (at most ``span``).

Texts are read once and never moved: a document sends its number of words and the fingerprints that a bitmap of the items'
hashes lets through. The bitmap has the same size for every benchmark; a larger benchmark lets more chance hashes pass to the join, where they end. Equal texts
share one digest, so their hits are extended once, and documents with the same set of contexts share
one list of items, so a passage in many items and many documents isn't written out for each pair. An item that shares a context
with others is a row beside it, never an entry of a list that all must carry.

Defined cases: a null or wordless text has no words, no hits and the digest of an empty list; a null or wordless item is no item; rows that repeat a doc_id are rows
of their own; rows that repeat an item_id are one item; the words of an item without id are hit, but it is neither counted nor listed;
no documents give no rows, no items give clean rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterglass.llm.common import register, stored, table

#: Words of a window, and of the k-grams that are hashed.
SPAN, GRAM = 10, 8
#: 64-bit words of the bitmap, a power of two: two megabytes.
BITMAP_WORDS = 1 << 18
#: All that stands between words before A-Z are lower-cased: words are letters and digits of ASCII, and everything beyond it.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often a lambda inside refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_in(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), BETWEEN), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(F.translate(w, UPPER, UPPER.lower())))


def gram_hashes(hashes: Column, gram: int) -> Column:
    """Hash of the k-gram at each word."""
    places = F.sequence(F.lit(0), F.size(hashes) - gram)
    rolled = F.transform(places, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(gram))))
    return F.when(F.size(hashes) >= gram, rolled).otherwise(F.array().cast("array<bigint>"))


def least_places(hashes: Column, window: int) -> Column:
    """The place of the last least hash of every run of ``window`` hashes; runs that share it repeat it."""
    def least(start: Column) -> Column:
        at = [F.get(hashes, start + j) for j in range(window)]
        place = start
        for j in range(1, window):
            last = F.lit(True)
            for other in range(window):
                if other != j:
                    last = last & (at[j] <= at[other] if other < j else at[j] < at[other])
            place = F.when(last, start + j).otherwise(place)
        return place
    starts = F.sequence(F.lit(0), F.size(hashes) - window)
    return F.when(F.size(hashes) >= window, F.transform(starts, least)).otherwise(F.array().cast("array<int>"))


def marked(words: Column, levels: Sequence[int], gram: int) -> Column:
    """(hashes, grams, marks) of a text: the words' hashes, the k-grams' hashes for each level, and the fingerprints.

    A mark is -1 for the text itself and place * levels + number of the level for a fingerprint: spans of as many words as the level
    says are guaranteed to be met.
    """
    def numbered(grams: Column, i: int) -> Column:
        places = let(F.get(grams, F.lit(i)), lambda own: least_places(own, levels[i] - min(levels[i], gram) + 1))
        return places if len(levels) == 1 else F.transform(places, lambda p: p * len(levels) + i)

    def picked(hashes: Column, grams: Column) -> Column:
        marks = F.concat(F.array(F.lit(-1)), *(numbered(grams, i) for i in range(len(levels))))
        return F.struct(hashes.alias("hashes"), grams.alias("grams"), marks.alias("marks"))
    return let(word_hashes(words), lambda hashes: let(
        F.array(*(gram_hashes(hashes, min(level, gram)) for level in levels)), lambda grams: picked(hashes, grams)))


def fingerprints(texts: DataFrame, levels: Sequence[int], gram: int, margin: int, chosen: Callable[[Column], Column]) -> DataFrame:
    """The columns besides ``words`` with (level, at, hash, before, after) of each fingerprint whose hash is chosen.

    ``before``, ``after``: hashes of the words beside the k-gram, the nearest first, null where the text ends. A row of level 0 stands for the
    text itself, its place is the number of words. Lists are built once for a text; from there on only plain columns
    are read, so that fingerprints that aren't chosen cost no more than a look at the bitmap.
    """
    keys = [c for c in texts.columns if c != "words"]
    rows = texts.select(*keys, marked(F.col("words"), levels, gram).alias("m"))
    rows = rows.select(*keys, "m.hashes", "m.grams", F.explode("m.marks").alias("mark"))
    number = F.pmod("mark", F.lit(len(levels))).cast("int")
    own = F.col("mark") < 0
    place = F.expr(f"mark div {len(levels)}").cast("int")
    rows = rows.withColumns({"level": F.when(own, 0).otherwise(F.get(F.array(*map(F.lit, levels)), number)),
                             "at": F.when(own, F.size("hashes")).otherwise(place),
                             "hash": F.when(~own, F.get(F.get("grams", number), place))})
    rows = rows.where(own | chosen(F.col("hash")))
    end = F.col("at") + F.least("level", F.lit(gram))

    def beside(places: Iterable[Column]) -> Column:
        return F.when(~own, F.array(*(F.get("hashes", p) for p in places)).cast("array<bigint>"))
    return rows.select(*keys, "level", "at", "hash", beside(F.col("at") - i for i in range(1, margin + 1)).alias("before"),
                       beside(end + i for i in range(margin)).alias("after"))


def agreeing(mine: str, other: str, margin: int) -> Column:
    """How many words agree in a row, from the k-gram outwards."""
    run, all_so_far = F.lit(0), F.lit(True)
    for i in range(margin):
        all_so_far = all_so_far & F.coalesce(F.get(mine, F.lit(i)) == F.get(other, F.lit(i)), F.lit(False))
        run = run + all_so_far.cast("int")
    return run


def word_of_bitmap(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BITMAP_WORDS.bit_length() + 1).cast("int")


def bitmap(hashes: DataFrame) -> DataFrame:
    """One row with a list of BITMAP_WORDS integers, whose bits are set where a hash of the column ``hash`` falls."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("hash").bitwiseAND(63).cast("int"))
    some = hashes.select(word_of_bitmap(F.col("hash")).alias("word"), bit.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = hashes.sparkSession.range(BITMAP_WORDS).select(F.col("id").cast("int").alias("word"))
    dense = every.join(some, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bitmap"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_sha256) of all documents, and the hit spans
    (text_sha256, start, end, context) of their distinct texts, in words; spans of one text may overlap."""
    margin = max(span - gram, 0)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words_in(F.col(item_text_col)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("level", F.least(F.size("words"), F.lit(span)))
    # At most ``span`` values.
    levels = sorted({span, *(r[0] for r in items.select("level").distinct().collect())})

    kept = fingerprints(items.withColumnRenamed("level", "own"), levels, gram, margin, lambda _: F.col("level") == F.col("own"))
    kept = kept.where(F.col("level") > 0).select("item", "level", "hash", F.col("before").alias("i_before"), F.col("after").alias("i_after"))
    members = stored(kept.withColumn("context", F.xxhash64("level", "hash", "i_before", "i_after")).distinct(), "items")
    known = members.drop("item").distinct()
    let_through = stored(bitmap(known), "bitmap")

    # The only reading of the texts.
    def passed(hashed: Column) -> Column:
        bits = F.get(let_through.select("bitmap").scalar(), word_of_bitmap(hashed))
        return F.call_function("shiftright", bits, hashed.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sent = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"), words_in(F.col(text_col)).alias("words"))
    sent = stored(fingerprints(sent, levels, gram, margin, passed), "sent")

    around = sent.where(F.col("level") > 0).drop("doc_id").distinct()
    k = F.least("level", F.lit(gram))
    left, right = agreeing("before", "i_before", margin), agreeing("after", "i_after", margin)
    met = around.join(known, ["level", "hash"]).select("sha", "context", "level", (F.col("at") - left).alias("start"),
                                                       (F.col("at") + k + right).alias("end"))
    spans = stored(met.where(F.col("end") - F.col("start") >= F.col("level")).select("sha", "start", "end", "context"), "spans")

    # Words under spans: what each adds to those before it.
    order = Window.partitionBy("sha").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.select("sha", "start", "end").distinct().withColumn("reached", F.coalesce(F.max("end").over(order), F.lit(0)))
    n_hit = covered.groupBy("sha").agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0))).alias("n_hit"))

    # Items: by distinct sets of contexts. A set is no longer than its text.
    sets = spans.groupBy("sha").agg(F.array_sort(F.collect_set("context")).alias("contexts"))
    sets = sets.withColumn("set", F.sha2(F.concat_ws(",", F.transform("contexts", lambda c: c.cast("string"))), 256))
    listed = sets.dropDuplicates(["set"]).select("set", F.explode("contexts").alias("context"))
    listed = listed.join(members.where(F.col("item").isNotNull()).select("context", "item"), "context").select("set", "item").distinct()
    listed = listed.groupBy("set").agg(F.count("*").alias("n_items"), F.sha2(
        F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    found = stored(n_hit.join(sets.select("sha", "set"), "sha").join(listed, "set", "left").drop("set"), "found")

    rows = sent.where(F.col("level") == 0).select("doc_id", "sha", F.col("at").cast("long").alias("n_words"))
    rows = rows.join(found, "sha", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
        F.lower(F.hex("sha")).alias("text_sha256"))
    return rows, spans.withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")


@register("op13_winnowing", """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
items AS (
  SELECT item_id, ws, least(len(ws), 10) AS size FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark)
  WHERE len(ws) > 0),
wanted AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT size FROM items),
present AS (
  SELECT r, size, i, array_to_string(ws[i:i + size - 1], ' ') AS win
  FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM texts, sizes WHERE len(ws) >= size)),
met AS (SELECT r, i, p.size, item_id FROM present p JOIN wanted w ON p.size = w.size AND p.win = w.win),
covered AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM met) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
""")
def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.drop("text_sha256")
