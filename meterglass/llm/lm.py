"""LM scoring with a hashed maximum-entropy model.

The probability of a token is that of its class given the context, times that of its member of the class given class and context, times
that of the token in its member. The most frequent tokens are members of their own, put into classes by frequency; the others share
members by their last letters. Class and member are each a trained softmax over hashed features: the token before, the two before (n-grams), and the
second and third before alone (skips). In a shared member tokens are counted, with one added.

Counts come from all training texts: blocks of texts send their distinct tokens with counts to buckets of the hash space and get
the sums back (see ``blocks``). Weights are trained by gradient updates in the tasks, each over its own texts from the same
start, and averaged by tokens; all training texts take part in each round, and the tree of sums holds a bounded part
at every node. Counts, weight changes and the slots of the model (with the third root of the training tokens) grow with the corpus. Scoring
looks features up in batches of tokens.

Defined cases: a null text counts as empty and has its end token only; a null id belongs to the training rows; rows that repeat an
id are texts of their own; without training rows all counts are 0 and every member is equally likely; no rows give no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterglass.llm import blocks as B
from meterglass.llm.common import U64, Words, mix, register, stored, table, word_hashes

FOLDS, HELD_OUT = 7, 2
#: Classes, and members of a class; members of single tokens and of shared endings.
WIDTH = 16
TOP, TAILS = 192, 64
MEMBERS = TOP + TAILS
assert MEMBERS == WIDTH * WIDTH
#: Slots of hashed features: a power of two of at least this many times the third root of the training tokens.
SLOTS_PER_ROOT, LEAST_BITS = 128, 12
BATCH, RATE, ROUNDS = 4096, 0.25, 1
#: Energies are cut here, so that no exponential overflows; probabilities still sum to one.
HIGHEST = np.float32(60)
#: Slots of a part of the weights that is summed apart, and how many copies of one part a node of the tree sums.
SLICE_SLOTS, FAN_IN = 1 << 12, 16
END, START = U64(0x5851F42D4C957F2D), U64(0)
FEATURES = 4
#: What tells the features' keys apart, and the classes whose members are chosen.
SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], U64)
CLASS_SALT = U64(0xD6E8FEB86659FD93)


class Tokens:
    """The tokens of some texts: lower-case words, then an end."""

    def __init__(self, texts: list[str | None]):
        words = Words(texts, lower=True)
        n = len(texts)
        at, ends = np.arange(len(words.starts)) + words.of, words.first[1:] + np.arange(n)
        self.hashes, self.of = np.empty(len(at) + n, U64), np.empty(len(at) + n, np.int64)
        self.tails = np.zeros(len(at) + n, np.int64)
        self.hashes[ends], self.of[ends] = END, np.arange(n)
        if len(at):
            self.hashes[at], self.of[at] = words.hashes(), words.of
            last = word_hashes(words.data, np.maximum(words.starts, words.ends - 2), words.ends)
            self.tails[at] = (last % U64(TAILS)).astype(np.int64)
        self.place = np.arange(len(self.of)) - (words.first[:-1] + np.arange(n))[self.of]
        self.counts = words.counts + 1

    def before(self, k: int) -> np.ndarray:
        out = np.full(len(self.hashes), START)
        out[k:] = self.hashes[:-k] if k else self.hashes
        return np.where(self.place >= k, out, START)

    def features(self) -> np.ndarray:
        """A 64-bit key for each feature and token."""
        one, two, three = (self.before(k) for k in (1, 2, 3))
        return np.stack([mix(k + salt) for k, salt in zip((one, mix(one) + two, two, three), SALTS)])

    def members(self, top: np.ndarray) -> np.ndarray:
        """Of each token; top: (sorted hashes, member of each)."""
        hashes, numbers = top
        at = np.minimum(np.searchsorted(hashes, self.hashes), len(hashes) - 1)
        return np.where(hashes[at] == self.hashes, numbers[at], TOP + self.tails)


def slot_bits(train_tokens: int) -> int:
    return max(LEAST_BITS, int(np.ceil(np.log2(SLOTS_PER_ROOT * max(train_tokens, 1) ** (1 / 3)))))


def in_training(ids: list, folds: int, held_out: int) -> np.ndarray:
    return np.array([i is None or zlib.crc32(str(i).encode()) % folds != held_out for i in ids], bool)


@dataclass
class Choices:
    """The two choices made for each token: its class, then its member of the class. Row 0 of each array is the first."""

    slots: np.ndarray
    bias: np.ndarray
    taken: np.ndarray

    def of(self, a: int, b: int) -> Choices:
        """Those for tokens a .. b - 1, in a row: all first choices, then all second."""
        return Choices(self.slots[:, :, a:b].reshape(FEATURES, -1), self.bias[:, a:b].ravel(), self.taken[:, a:b].ravel())


@dataclass
class Model:
    """Weights of the choices by slot; the first row of the bias is for classes, the others for the members of each class."""

    top: tuple[np.ndarray, np.ndarray]
    bias: np.ndarray
    member_tokens: np.ndarray
    member_words: np.ndarray
    weights: np.ndarray

    def choices(self, tokens: Tokens, members: np.ndarray) -> Choices:
        classes, keys = members // WIDTH, tokens.features()
        bits = U64(64 - int(len(self.weights)).bit_length() + 1)
        inner = mix(keys + (classes.astype(U64) + U64(1)) * CLASS_SALT)
        return Choices((np.stack([keys, inner], axis=1) >> bits).astype(np.int32), np.stack([np.zeros_like(classes), classes + 1]),
                       np.stack([classes, members % WIDTH]))

    def energies(self, made: Choices, weights: np.ndarray | None = None) -> np.ndarray:
        """Logs of the probabilities of what can be taken, less a constant for each choice."""
        w = self.weights if weights is None else weights
        out = self.bias.take(made.bias, axis=0)
        for s in made.slots:
            out += w.take(s, axis=0)
        return np.minimum(out, HIGHEST, out=out)

    def member_logs(self, tokens: Tokens, members: np.ndarray) -> np.ndarray:
        """Natural log of the probability of a member for each token."""
        every, out = self.choices(tokens, members), np.empty(len(members))
        for a in range(0, len(members), BATCH):
            b = min(a + BATCH, len(members))
            made = every.of(a, b)
            found = self.energies(made)
            logs = found[np.arange(len(found)), made.taken] - np.log(np.exp(found, out=found).sum(axis=1))
            out[a:b] = logs[:b - a].astype(float) + logs[b - a:]
        return out


def token_counts(staged: DataFrame, n: int, folds: int, held_out: int) -> DataFrame:
    """Answers: the training counts of the tokens each block asked for; the rows of block -1 sum up a bucket."""
    def ask(rows: pa.Table) -> pa.Table:
        tokens = Tokens(rows["text"].to_pylist())
        train = in_training(rows["doc_id"].to_pylist(), folds, held_out)
        values, first, which = np.unique(tokens.hashes, return_index=True, return_inverse=True)
        counts = np.bincount(which, train[tokens.of], minlength=len(values)).astype(U64)
        return B.ask_rows(B.asked(rows["block"][0].as_py(), 0, B.split(values, n), (values, 8),
                                  (tokens.tails[first].astype(U64), 1), (counts, 4)))

    def answer(bucket: pa.Table) -> pa.Table:
        parts = [B.unpack(p, 8, 1, 4) for p in bucket["payload"].to_pylist()]
        hashes, tails, counts = (np.concatenate(c) for c in zip(*parts))
        values, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        # Sums of integers below 2 ** 53 are exact in doubles.
        sums = np.bincount(which, counts.astype(np.float64), minlength=len(values)).astype(U64)
        ends = np.cumsum([0] + [len(p[0]) for p in parts])
        told = [sums[which[a:b]].tobytes() if sums[which[a:b]].max() >> U64(32) else sums[which[a:b]].astype("<u4").tobytes()
                for a, b in zip(ends[:-1], ends[1:])]
        seen = sums > 0
        tail = tails[first][seen].astype(np.int64)
        best = np.argsort(-sums[seen].astype(np.int64), kind="stable")[:TOP]
        summary = np.concatenate([np.bincount(tail, sums[seen], minlength=TAILS), np.bincount(tail, minlength=TAILS)]).astype("<u8").tobytes() + \
            np.stack([values[seen][best], tail[best].astype(U64), sums[seen][best]], axis=1).astype("<u8").tobytes()
        b = bucket["bucket"][0].as_py()
        return B.ask_rows([*((0, b, block, t) for block, t in zip(bucket["block"].to_pylist(), told)), (0, b, -1, summary)])

    return B.per_block(staged, ask, B.ASK).groupBy("bucket").applyInArrow(answer, B.ASK)


def start_model(answers: DataFrame) -> tuple[Model, int, int]:
    """The model before training, all training tokens, and how many of them are distinct."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for payload in batch.column("payload").to_pylist():
                data = np.frombuffer(payload, "<u8")
                out += [(None, t, int(data[t]), int(data[TAILS + t])) for t in range(TAILS)]
                out += [(h - (1 << 64) if h >> 63 else h, t, c, 0) for h, t, c in data[2 * TAILS:].reshape(-1, 3).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["hash", "tail", "n", "words"])

    found = answers.where("block = -1").mapInArrow(rows, "hash long, tail long, n long, words long")
    sums = found.where("hash IS NULL").groupBy("tail").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()
    tokens, words = np.zeros(MEMBERS), np.zeros(MEMBERS)
    for r in sums:
        tokens[TOP + r["tail"]], words[TOP + r["tail"]] = r["n"], r["words"]
    n_tokens, n_words = int(tokens.sum()), int(words.sum())
    end = int(END) - (1 << 64) if int(END) >> 63 else int(END)
    # The end is always a member of its own.
    top = found.where("hash IS NOT NULL").orderBy((F.col("hash") == end).desc(), F.desc("n"), "hash").limit(TOP).collect()
    seen = {r["hash"]: r for r in top}
    hashes = [end] + [h for h in seen if h != end][:TOP - 1]
    for i, h in enumerate(hashes):
        if h in seen:
            tokens[TOP + seen[h]["tail"]] -= seen[h]["n"]
            words[TOP + seen[h]["tail"]] -= 1
            tokens[i], words[i] = seen[h]["n"], 1
    hashes = np.array(hashes, np.int64).view(U64)
    order = np.argsort(hashes)
    inner = tokens.reshape(WIDTH, WIDTH)
    classes = inner.sum(axis=1, keepdims=True)
    bias = np.log(np.concatenate([(classes.T + 1) / (n_tokens + WIDTH), (inner + 1) / (classes + WIDTH)])).astype(np.float32)
    return Model((hashes[order], order), bias, tokens, words, np.zeros((1 << slot_bits(n_tokens), WIDTH), np.float32)), n_tokens, n_words


def by_slot(slots: np.ndarray) -> np.ndarray:
    """A stable order. Sixteen bits are sorted by radix, so wider slots are sorted in two steps."""
    order = np.argsort(slots.astype(np.uint16), kind="stable")
    high = (slots >> 16)[order]
    return order if not high.any() else order[np.argsort(high.astype(np.uint16), kind="stable")]


def updated(weights: np.ndarray, squares: np.ndarray, slots: np.ndarray, gap: np.ndarray) -> None:
    """One gradient step, in place: each slot by the gaps of its choices, scaled by what the slot has seen."""
    for s in slots:
        order = by_slot(s)
        keys = s[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        times = np.diff(first, append=len(keys))
        step = gap.take(order[first], axis=0)
        again = times > 1
        if again.any():
            # Only slots with several choices are summed; most have one.
            step[again] = np.add.reduceat(gap.take(order[np.repeat(again, times)], axis=0), np.cumsum(times[again]) - times[again], axis=0)
        rows = keys[first]
        seen = squares[rows] + np.einsum("ij,ij->i", step, step)
        squares[rows] = seen
        step *= (np.float32(RATE) / np.sqrt(seen + np.float32(1)))[:, None]
        weights[rows] += step


def learned(model: Model, weights: np.ndarray, squares: np.ndarray, tokens: Tokens) -> int:
    """Steps over all tokens, in place; how many there are."""
    members = tokens.members(model.top)
    every = model.choices(tokens, members)
    for a in range(0, len(members), BATCH):
        made = every.of(a, min(a + BATCH, len(members)))
        # What was seen less what was expected.
        gap = model.energies(made, weights)
        np.exp(gap, out=gap)
        gap /= -gap.sum(axis=1, keepdims=True)
        gap[np.arange(len(gap)), made.taken] += 1
        updated(weights, squares, made.slots, gap)
    return len(members)


def train(staged: DataFrame, model: Model, folds: int, held_out: int, rounds: int) -> Model:
    spark = staged.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            weights, squares, seen = model.weights.copy(), np.zeros(len(model.weights), np.float32), 0
            for texts in training_groups(batches, folds, held_out):
                seen += learned(model, weights, squares, Tokens(texts))
            if seen:
                me = TaskContext.get().partitionId()
                for i, a in enumerate(range(0, len(weights), SLICE_SLOTS)):
                    change = (weights[a:a + SLICE_SLOTS] - model.weights[a:a + SLICE_SLOTS]) * np.float32(seen)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([me], pa.int64()), pa.array([seen], pa.int64()), pa.array([change.tobytes()], pa.binary())],
                        ["slice", "part", "seen", "change"])

        def total(rows: pa.Table) -> pa.Table:
            change = np.zeros(len(rows["change"][0].as_py()) // 4, np.float32)
            for c in rows["change"]:
                change += np.frombuffer(c.as_buffer(), np.float32)
            return pa.table({"slice": rows["slice"][:1], "part": rows["part"][:1], "seen": pa.array([pa.compute.sum(rows["seen"]).as_py()]),
                             "change": pa.array([change.tobytes()], pa.binary())})

        schema = "slice int, part long, seen long, change binary"
        texts = staged.select("doc_id", "text")
        changes, width = stored(texts.mapInArrow(learn, schema), "changes"), 1
        top = (changes.agg(F.max("part")).first()[0] or 0) + 1
        while width < top:
            width *= FAN_IN
            changes = (changes.withColumn("node", F.floor(F.col("part") / width)).groupBy("slice", "node")
                       .applyInArrow(lambda rows: total(rows.drop_columns(["node"])), schema))
        parts = {r["slice"]: r for r in changes.collect()}
        if parts:
            change = np.concatenate([np.frombuffer(parts[i]["change"], np.float32) / np.float32(parts[i]["seen"]) for i in sorted(parts)])
            model = replace(model, weights=model.weights + change.reshape(model.weights.shape))
    return model


def training_groups(batches: Iterator[pa.RecordBatch], folds: int, held_out: int) -> Iterator[list[str | None]]:
    """Training texts, some megabytes at a time."""
    held, size = [], 0
    for batch in batches:
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            if in_training([i], folds, held_out)[0]:
                text = text.as_py()
                held.append(text)
                size += len(text or "")
                if size > B.BLOCK_BYTES:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT,
              rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all rows; scores are base-10 logs."""
    spark = docs.sparkSession
    staged = B.stage(docs, id_col, text_col)
    n = B.bucket_count(staged)
    answers = stored(token_counts(staged, n, folds, held_out), "counts")
    model, n_tokens, n_words = start_model(answers)
    shared = spark.sparkContext.broadcast(train(staged, model, folds, held_out, rounds))

    def score(rows: pa.Table, told: dict[tuple[int, int], bytes]) -> pa.Table:
        model, ids = shared.value, rows["doc_id"].to_pylist()
        tokens = Tokens(rows["text"].to_pylist())
        values, which = np.unique(tokens.hashes, return_inverse=True)
        cuts, known = B.split(values, n), np.zeros(len(values), np.int64)
        for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                payload = told[0, bucket]
                known[a:b] = np.frombuffer(payload, "<u4" if len(payload) == 4 * (b - a) else "<u8")
        counts = known[which]
        base = np.log10((counts + 1) / (n_tokens + n_words + 1))
        members = tokens.members(model.top)
        inside = np.where(members < TOP, 0.0, np.log10((counts + 1) / (model.member_tokens + model.member_words + 1)[members]))
        per_token = inside + model.member_logs(tokens, members) / np.log(10)
        size = len(ids)
        return pa.table({
            "doc_id": rows["doc_id"], "held_out": pa.array(~in_training(ids, folds, held_out)),
            "n_tokens": pa.array(tokens.counts.astype(np.int64)), "n_known": pa.array(np.bincount(tokens.of, counts > 0, minlength=size).astype(np.int64)),
            "train_tokens": pa.array(np.full(size, n_tokens, np.int64)), "base_score": pa.array(np.bincount(tokens.of, base, minlength=size)),
            "score": pa.array(np.bincount(tokens.of, per_token, minlength=size))})

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return B.with_answers(staged, answers.where("block >= 0"), score, schema)


@register("op3_hashed_maxent")
def op3_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
