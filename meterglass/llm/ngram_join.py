"""N-gram Jaccard join in a metric space: pivots, regions, windows, exact joins.

Sets are the distinct word n-grams of the texts; equal sets are one class. Jaccard distance between unrelated texts is 1, and so it is between
a text and almost any other text taken as a pivot: plain Voronoi regions of pivot texts would hold nearly all texts. So the first
pivots are sets of one n-gram, all there are, ordered from rare to frequent:

* The region of a class is its first n-gram. The windows follow from the triangle inequality of the symmetric difference with
  the set P of a class's first k n-grams: a set B that misses all of P is at least |B| - |A| + 2k away from A, which is beyond
  the threshold once k > (1 - t)|A|. So a class is replicated to the regions of its first floor((1 - t)|A|) + 1 n-grams, and no link is lost.
* Where these n-grams occur in no other class the text has no partner. Most texts end here.
* Regions that share classes are joined into groups (components of the classes that meet in a region). A link never leaves its group.
* Inside a group texts are near and pivot texts do divide it. Each class of a large group meets the pivots and its own share of the group once; the links found there
  merge most of a group of near copies, and only classes of different parts have still to meet. Who meets whom is one of three covers, the one that
  moves the fewest n-grams: the Voronoi cells of the pivots (a boundary class x, in the cell of p, also stands in the cell of q where d(x, q) - d(x, p) <= 2 r),
  the regions (n-grams of windows, which a chain of shared passages leaves small), or the group as it is. Covers hold numbers of classes, no sets; a part that holds
  one label is done, and one beyond a task is dealt out as pairs of chunks of the classes outside the group's largest label and of all. What fits a task is joined exactly, with integer counts.

Every join returns a forest of the links it found, a row for each text at most; no group is expanded into pairs.

Defined cases: null and empty texts, and texts without words, have the empty set: component of their own, 0 n-grams; texts with fewer words than n have
their whole sequence as the only n-gram; rows that repeat an id are linked by their equal sets; no rows give
no rows; a null id is never the smallest of a component that has another; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterglass.llm import blocks as B
from meterglass.llm.common import U64, Words, mix, register, stored, table, window_hashes
from meterglass.llm.components import components

#: Classes that one task joins, and n-grams in them where the classes are more than a few.
GROUP_CLASSES, GROUP_GRAMS, FEW = 512, 4_000_000, 64
#: Pivot texts of a large group, and classes of a chunk in shares of GROUP_CLASSES.
PIVOTS, CHUNK = 32, 2
#: What a row of a large group's first meeting tells: a link, a class of the same part, or a class's own cell, one below it or one above it in its reach.
LINK, PART, OWN, BELOW, ABOVE = range(5)


def gram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct n-grams."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    at = words.windows(hashes, n)
    grams, of = window_hashes(hashes, at, n), words.of[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        # The number of words keeps a short text apart from the n-grams of others.
        whole = window_hashes(hashes, words.first[short], words.counts[short])
        grams = np.concatenate((grams, mix(whole + words.counts[short].astype(U64))))
        of = np.concatenate((of, short))
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    return np.split(grams[new], np.searchsorted(of[new], np.arange(1, len(texts))))


def window(size: int, percent: int) -> int:
    """How many first n-grams of a set cannot all be missing from a linked one."""
    return size - -(-percent * size // 100) + 1


def frequency_code(counts: np.ndarray) -> np.ndarray:
    """Frequencies in one byte, rising with them."""
    return np.where(counts < 200, counts, np.minimum(255, 200 + 2 * np.log2(np.maximum(counts, 200) / 200))).astype(np.uint8)


class Postings:
    """Overlaps of one set with many."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.n = len(sets)
        grams, of = np.concatenate(sets), np.repeat(np.arange(self.n), self.sizes)
        order = np.argsort(grams, kind="stable")
        self.of = of[order]
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.first = np.append(self.first, len(grams))

    def overlaps(self, one: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.grams, one), len(self.grams) - 1)
        at = at[self.grams[at] == one]
        starts, lengths = self.first[at], self.first[at + 1] - self.first[at]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
        return np.bincount(self.of[places], minlength=self.n)


def forest(ids: np.ndarray, sets: list[np.ndarray], inner: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (a, b) that connect what the links of the group connect; two outer classes are left to their own group."""
    root = np.arange(len(ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    postings, out = Postings(sets), []
    for i in np.flatnonzero(inner):
        if len(out) == len(ids) - 1:
            break
        common = postings.overlaps(sets[i])
        linked = np.flatnonzero(100 * common >= percent * (postings.sizes + len(sets[i]) - common))
        for j in linked:
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[j])))
    return out


def unpacked(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    if not rows.num_rows:
        return np.empty(0, np.int64), []
    return np.array(rows["class"].to_pylist(), np.int64), [np.frombuffer(s.as_buffer(), U64) for s in rows["grams"]]


def local_links(rows: DataFrame, by: str, percent: int) -> DataFrame:
    """Links (a, b) of what shares ``by`` in rows (by, class, grams, inner); a forest for each."""
    def local(group: pa.Table) -> pa.Table:
        ids, sets = unpacked(group)
        links = forest(ids, sets, np.array(group["inner"].to_pylist(), bool), percent)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*links) if links else ([], []))], ["a", "b"])
    return stored(rows.select(by, "class", "grams", "inner").groupBy(by).applyInArrow(local, "a long, b long"), "links")


def shares(classes: Column, total: Column, group_classes: int, grams: int) -> Column:
    return F.ceil(F.greatest(classes / group_classes, total / grams)).cast("long")


def group_links(rows: DataFrame, percent: int, group_classes: int = GROUP_CLASSES) -> DataFrame:
    """Links (a, b) of the groups in rows (group, class, n, grams, pivots): forests that connect what the links of a group connect."""
    big = (F.col("classes") > group_classes) | (F.col("total") > GROUP_GRAMS) & (F.col("classes") > FEW)
    found = local_links(rows.where(~big).withColumn("inner", F.lit(True)), "group", percent)
    large = rows.where(big)
    if large.isEmpty():
        return found
    large = stored(large.withColumn("shares", shares(F.col("classes"), F.col("total"), group_classes, GROUP_GRAMS))
                   .withColumn("is_pivot", F.pmod(F.xxhash64("class"), F.col("classes")) < F.least(4 * F.col("shares"), F.expr("classes div 4"), F.lit(PIVOTS))), "large")
    met = stored(first_meeting(large, percent), "met")
    links = met.where(F.col("kind") == LINK).select("a", "b")
    dealt = dealt_out(large.select("group", "class", "n", "pivots", "is_pivot"), met, CHUNK * group_classes)
    sets = large.select(F.col("class").alias("s_class"), "grams")
    return found.unionByName(links).unionByName(local_links(dealt.join(sets, F.col("class") == F.col("s_class")), "task", percent))


def named_parts(links: list[tuple[int, int]], first: list[int]) -> list[tuple[int, int]]:
    """(a, name) of all in the links; the name of what they connect: the smallest of ``first`` in it, else the smallest of all."""
    root: dict[int, int] = {}
    firsts = set(first)

    def find(x: int) -> int:
        while (y := root.setdefault(x, x)) != x:
            root[x] = root[y]
            x = y
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)), key=lambda x: (x not in firsts, x))
        root[b] = a
    return [(x, find(x)) for x in list(root)]


def first_meeting(large: DataFrame, percent: int) -> DataFrame:
    """(group, a, b, kind): links of each share of a large group in itself and with all pivots of the group, the parts these make
    (named by their smallest pivot, else by their smallest class), then the cells in each class's reach."""
    def meet(key: tuple, texts: pa.Table, pivots: pa.Table) -> pa.Table:
        ids, sets = unpacked(texts)
        p_ids, p_sets = unpacked(pivots)
        out = []
        if len(ids):
            inner = np.repeat([True, False], [len(ids), len(p_ids)])
            out = [(a, b, LINK) for a, b in forest(np.concatenate((ids, p_ids)), sets + p_sets, inner, percent) if a != b]
            out += [(a, b, PART) for a, b in named_parts([(a, b) for a, b, _ in out], p_ids.tolist())]
        if len(ids) and len(p_ids):
            order, known = np.argsort(p_ids), set(p_ids.tolist())
            p_ids, postings = p_ids[order], Postings([p_sets[i] for i in order])
            for c, one in zip(ids.tolist(), sets):
                if c in known:
                    continue
                common = postings.overlaps(one)
                gaps = 1 - common / (postings.sizes + len(one) - common)
                near = int(np.argmin(gaps))
                # The window is widened by what rounding may take.
                reach = np.flatnonzero(gaps - gaps[near] <= 2 * (1 - percent / 100) + 1e-9)
                out += [(c, int(p_ids[q]), OWN if q == near else BELOW if q < near else ABOVE) for q in reach]
        columns = list(zip(*out)) if out else [[]] * 3
        return pa.table([pa.array([key[0].as_py()] * len(out), pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.int32())], ["group", "a", "b", "kind"])

    salted = large.withColumn("salt", F.pmod(F.xxhash64("class", F.lit("salt")), F.col("shares")))
    pivots = large.where("is_pivot").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    return (salted.select("group", "salt", "class", "grams").groupBy("group", "salt")
            .cogroup(pivots.select("group", "salt", "class", "grams").groupBy("group", "salt"))
            .applyInArrow(meet, "group long, a long, b long, kind int"))


def dealt_out(large: DataFrame, met: DataFrame, chunk: int) -> DataFrame:
    """(task, class, inner): who has still to meet, by the cheapest cover of each group.

    A link that no earlier one implies joins classes of two labels, so one of them is outside the group's largest label: these
    are inner. Pivots have met all. Parts without an inner class or with one label only are done; of parts of the same classes one stays.
    """
    def merged(rows: pa.Table) -> pa.Table:
        names = named_parts(list(zip(rows["a"].to_pylist(), rows["b"].to_pylist())), [])
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*names) if names else ([], []))], ["pivot", "pivot_label"])

    # Shares name one part by several pivots; a pivot is in as many parts as the group has shares, and a group has few pivots.
    parts = met.where(F.col("kind") == PART).select("group", "a", "b")
    pivots = large.where("is_pivot").select(F.col("class").alias("p_class"))
    by_pivots = parts.join(pivots, F.col("a") == F.col("p_class")).groupBy("group").applyInArrow(merged, "pivot long, pivot_label long")
    parts = parts.groupBy("a").agg(F.min("b").alias("name")).join(by_pivots, F.col("name") == F.col("pivot"), "left")
    named = stored(large.join(parts, F.col("class") == F.col("a"), "left").select(
        "group", "class", "n", "pivots", "is_pivot", F.coalesce("pivot_label", "name", "class").alias("label")), "named")
    tops = (named.groupBy("group", "label").agg(F.count("*").alias("members"), F.max("is_pivot").alias("has_pivots")).groupBy(F.col("group").alias("t_group"))
            .agg(F.max(F.struct("members", "label"))["label"].alias("top"), F.count("*").alias("labels"), F.max("has_pivots").alias("has_pivots")))
    left = stored(named.where("NOT is_pivot").join(tops.where("labels > 1"), F.col("group") == F.col("t_group"))
                  .select("group", "class", "n", "pivots", "label", (F.col("label") != F.col("top")).alias("inner"), "has_pivots"), "open")
    columns = ["group", "cover", "part", "class", "n", "label", "inner", "has_pivots"]
    whole = left.withColumns({"cover": F.lit(0), "part": F.col("group")}).select(columns)
    regions = left.withColumns({"cover": F.lit(1), "part": F.explode("pivots")}).select(columns)
    reach = met.where(F.col("kind") >= OWN).select(F.col("a").alias("r_class"), F.col("b").alias("part"), "kind")
    # Of two inner classes the one in the lower cell looks for the other; an outer class is looked for in all its reach.
    cells = (left.join(reach, F.col("class") == F.col("r_class")).where((F.col("kind") != ABOVE) | ~F.col("inner"))
             .withColumns({"cover": F.lit(2), "inner": F.col("inner") & (F.col("kind") == OWN)}).select(columns))
    covers = stored(whole.unionByName(regions).unionByName(cells), "covers")

    inner = F.col("inner").cast("long")
    sums = (covers.groupBy("group", "cover", "part").agg(
        F.sum(inner).alias("m"), F.count("*").alias("c"), F.sum(inner * F.col("n")).alias("m_n"), F.sum("n").alias("c_n"),
        F.min("label").alias("low"), F.max("label").alias("high"), F.max("has_pivots").alias("has_pivots"),
        F.bit_xor(F.xxhash64("class", "inner")).alias("x1"), F.bit_xor(F.xxhash64("class", "inner", F.lit("again"))).alias("x2"))
        .where("m > 0 AND low <> high"))
    key = ["group", "cover", "m", "c", "m_n", "c_n"]
    sums = sums.groupBy(*key, "x1", "x2").agg(F.min("part").alias("part"), F.max("has_pivots").alias("has_pivots"))
    sums = stored(sums.withColumns({"m_chunks": shares(F.col("m"), F.col("m_n"), chunk, GROUP_GRAMS // 2),
                                    "c_chunks": shares(F.col("c"), F.col("c_n"), chunk, GROUP_GRAMS // 2)}), "sums")

    # N-grams that each cover moves. A group without pivots has no cells; without open parts regions and cells cost nothing.
    moved = F.when(F.col("c_chunks") == 1, F.col("c_n")).otherwise(F.col("m_n") * F.col("c_chunks") + F.col("c_n") * F.col("m_chunks"))
    cost = [F.coalesce(F.sum(F.when(F.col("cover") == i, moved)), F.lit(0)).alias(f"cost{i}") for i in range(3)]
    best = sums.groupBy(F.col("group").alias("b_group")).agg(*cost, F.max("has_pivots").alias("any_pivots")).select("b_group", F.when(
        F.col("any_pivots") & (F.col("cost2") < F.least("cost0", "cost1")), 2).when(F.col("cost1") < F.col("cost0"), 1).otherwise(0).alias("best"))
    chosen = stored(sums.join(best, (F.col("group") == F.col("b_group")) & (F.col("cover") == F.col("best"))).select(
        F.col("group").alias("k_group"), F.col("cover").alias("k_cover"), F.col("part").alias("k_part"), "m_chunks", "c_chunks"), "chosen")

    rows = covers.join(chosen, (F.col("group") == F.col("k_group")) & (F.col("cover") == F.col("k_cover")) & (F.col("part") == F.col("k_part")))
    rows = stored(rows.select("group", "cover", "part", "class", "inner", "m_chunks", "c_chunks"), "dealt")

    def task(*places: Column) -> Column:
        return F.xxhash64("group", "cover", "part", *places).alias("task")

    def own(chunks: str) -> Column:
        return F.pmod(F.xxhash64("class", F.lit("chunk")), F.col(chunks))

    def each(chunks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(chunks) - 1))

    many = F.col("c_chunks") > 1
    whole = rows.where(~many).select(task(), "class", "inner")
    looking = rows.where(many & F.col("inner")).withColumns({"i": own("m_chunks"), "j": each("c_chunks")})
    looked_for = rows.where(many).withColumns({"i": each("m_chunks"), "j": own("c_chunks")}).withColumn("inner", F.lit(False))
    return whole.unionByName(looking.unionByName(looked_for).select(task(F.col("i"), F.col("j")), "class", "inner"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85,
                       group_classes: int = GROUP_CLASSES) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_size) of all rows: links where 100 * common >= percent * together."""
    staged = B.stage(docs, id_col, text_col)
    buckets = B.bucket_count(staged)
    kind = docs.schema[id_col].dataType.simpleString()

    def mark(rows: pa.Table) -> pa.Table:
        sets = gram_sets(rows["text"].to_pylist(), n)
        keys = [(len(s), int(np.sum(mix(s), dtype=U64).view(np.int64)), int(np.bitwise_xor.reduce(mix(s ^ U64(0x5bd1e995))).view(np.int64)) if len(s) else 0)
                for s in sets]
        return pa.table([rows["doc_id"], rows["block"], rows["row"], *(pa.array(c, pa.int64()) for c in zip(*keys))],
                        ["doc_id", "block", "row", "n", "k1", "k2"])

    marks = stored(B.per_block(staged, mark, f"doc_id {kind}, block long, row int, n long, k1 long, k2 long"), "marks")
    place = F.struct("block", "row")
    classes = stored(marks.where("n > 0").groupBy("n", "k1", "k2").agg(
        F.min(place).alias("first"), F.min("doc_id").alias("least_id"), F.count("*").alias("members"))
        .select("n", "k1", "k2", "least_id", "members", F.col("first.block").alias("block"), F.col("first.row").alias("row"))
        .withColumn("class", F.col("block") * (1 << 22) + F.col("row")), "classes")
    firsts = classes.select("block", "row", "class")

    def own_sets(rows: pa.Table, own: pa.Table) -> tuple[list[int], list[np.ndarray]]:
        numbers = dict(zip(own["row"].to_pylist(), own["class"].to_pylist()))
        chosen = [(numbers[r], t) for r, t in zip(rows["row"].to_pylist(), rows["text"]) if r in numbers]
        return [c for c, _ in chosen], gram_sets([t.as_py() for _, t in chosen], n) if chosen else []

    def ask(rows: pa.Table, own: pa.Table) -> pa.Table:
        ids, sets = own_sets(rows, own) if own.num_rows else ([], [])
        if not ids:
            return B.ask_rows(iter(()))
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        return B.ask_rows(B.asked(rows["block"][0].as_py(), 0, B.split(values, buckets), (values, 5), (counts.astype(U64), 3)))

    def frequencies(payloads: list[bytes]) -> list[bytes]:
        parts = [B.unpack(p, 5, 3) for p in payloads]
        _, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        codes = frequency_code(np.bincount(which, np.concatenate([p[1] for p in parts]).astype(np.float64)))[which]
        ends = np.cumsum([0] + [len(p[0]) for p in parts])
        # A bit for each n-gram that is elsewhere, then their codes.
        return [np.packbits(codes[a:b] > 1).tobytes() + codes[a:b][codes[a:b] > 1].tobytes() for a, b in zip(ends[:-1], ends[1:])]

    answers = stored(B.answered(B.with_rows(staged, firsts, ask, B.ASK), frequencies), "frequencies")

    def survivors(rows: pa.Table, told: pa.Table) -> pa.Table:
        ids, sets = own_sets(rows, told.filter(pa.compute.is_valid(told["class"]))) if told.num_rows else ([], [])
        out = []
        if ids:
            values = np.unique(np.concatenate(sets))
            cuts = B.split(values, buckets)
            codes = np.ones(len(values), np.uint8)
            answer = told.filter(pa.compute.is_valid(told["payload"]))
            payloads = dict(zip(answer["bucket"].to_pylist(), answer["payload"].to_pylist()))
            for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a:
                    data = np.frombuffer(payloads[bucket], np.uint8)
                    many = np.flatnonzero(np.unpackbits(data[:-(-(b - a) // 8)], count=b - a))
                    codes[a + many] = data[-(-(b - a) // 8):]
            for c, s in zip(ids, sets):
                code = codes[np.searchsorted(values, s)]
                width = window(len(s), percent)
                if np.count_nonzero(code == 1) < width:
                    first = np.lexsort((s, code))[:width]
                    out.append((c, len(s), s.tobytes(), s[first][code[first] > 1].view(np.int64)))
        columns = list(zip(*out)) if out else [[]] * 4
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()),
                         pa.array(list(columns[3]), pa.list_(pa.int64()))], ["class", "n", "grams", "pivots"])

    told = answers.select("block", "bucket", "payload", F.lit(None).cast("int").alias("row"), F.lit(None).cast("long").alias("class")).unionByName(
        firsts.select("block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("payload"), "row", "class"))
    near = stored(B.with_rows(staged, told, survivors, "class long, n long, grams binary, pivots array<long>"), "survivors")

    # Regions: classes whose windows hold the same pivot, each hung on the smallest of them.
    windows = near.select("class", F.explode("pivots").alias("pivot"))
    regions = stored(windows.groupBy(F.col("pivot").alias("r_pivot")).agg(F.min("class").alias("first")), "regions")
    groups = components(windows.join(regions, F.col("pivot") == F.col("r_pivot")).select(F.col("class").alias("a"), F.col("first").alias("b")))
    members = stored(near.select("class", "n").join(groups, F.col("class") == F.col("node")).select("class", "n", F.col("label").alias("group")), "members")
    sizes = members.groupBy(F.col("group").alias("s_group")).agg(F.count("*").alias("classes"), F.sum("n").alias("total"))
    placed = members.drop("n").join(sizes, F.col("group") == F.col("s_group")).select(F.col("class").alias("m_class"), "group", "classes", "total")
    # Sets move here once, by class; a group's size has come to its classes before.
    rows = stored(near.join(placed, F.col("class") == F.col("m_class")).drop("m_class"), "groups")
    labels = components(group_links(rows, percent, group_classes))

    known = classes.join(labels, F.col("class") == F.col("node"), "left").select(
        "n", "k1", "k2", "least_id", "members", F.coalesce("label", "class").alias("label"))
    least = stored(known.groupBy(F.col("label").alias("l_label")).agg(F.min("least_id").alias("component_id"), F.count("*").alias("parts"))
                   .where("parts > 1"), "components")
    known = stored(known.join(least, F.col("label") == F.col("l_label"), "left").select(
        F.col("n").alias("c_n"), F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.coalesce("component_id", "least_id").alias("component_id"),
        "members"), "known")
    same = (F.col("n") == F.col("c_n")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    return marks.join(known, same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("members", F.lit(1).cast("long")).alias("class_size"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The documents of which one of each component stays, that with the smallest id, with all their columns.

    Rows that share that id stay together; texts without words all stay.
    """
    found = jaccard_components(docs, id_col, text_col, n, percent)
    keep = found.where((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("keep_id")).distinct()
    rows = docs.select(F.col(id_col).alias("id"), F.struct("*").alias("whole"))
    return rows.join(keep, F.col("id").eqNullSafe(F.col("keep_id")), "left_semi").select("whole.*")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM w, range(1, len(ws) - 2) t(i) WHERE len(ws) >= 4
      UNION ALL SELECT doc_id, len(ws) || ':' || array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y WHERE 100 * common >= 85 * (a.n + b.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other),
k AS (SELECT md5(coalesce(string_agg(g, '|' ORDER BY g), w.doc_id::VARCHAR)) AS key, w.doc_id FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id)
SELECT r.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(other) AS component_id,
       any_value(m.members)::BIGINT AS class_size
FROM r LEFT JOIN z ON z.doc_id = r.doc_id
JOIN (SELECT doc_id, count(*) OVER (PARTITION BY key) AS members FROM k) m ON m.doc_id = r.doc_id
GROUP BY r.doc_id
"""


@register("op2_jaccard_join", SQL)
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
