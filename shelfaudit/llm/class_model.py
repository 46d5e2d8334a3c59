"""Language-model scores by Brown class-based bigrams.

A-Z is lower-cased. Words belong to classes; the model is P(class | class before) * P(word | class).
Exchange clustering moves one unit after the other to the class that makes the
training text likeliest, until none moves. Its units are the `CORE` most frequent
words and, for all others, the `ENDINGS` most frequent word shapes (the last two
bytes), so the counts of pairs of units, which the driver clusters,
have a size fixed by these parameters. These classes are the seed: every further
training word then goes to the class with the greatest gain of likelihood by the
seed classes beside it, counted over the whole training text: summed by word and
class first, so that a word has at most two rows for each class when they meet. Words that are not in the training text have the class of their shape.

The `FREQUENT` most frequent words are looked up in the tasks (a table of fixed
size); the others are joined with their classes and counts, one row for each word
of a document. A document is then a string of classes, a byte for each word, of
which class pairs are counted and scores are added up. Words are told apart by a
64-bit hash.

Defined results: null text is empty and has only its end token; without training
documents every probability is the smoothed one of an unseen word; repeated rows
are scored each; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import cut, documents, fold

FOLDS = 5
HELD_OUT = 1
CORE = 700
ENDINGS = 300
CLASSES = 48
FREQUENT = 200_000
MERGE_ROWS = 1 << 21
COUNT_BITS = 40
SMOOTH = 0.5
BACK_OFF = 5.0

Batches = Iterator[pa.RecordBatch]
END = 0  # the unit and the class of the end token


def _lookup(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value is in a sorted table, and whether it is there at all."""
    at = np.searchsorted(table, values)
    if not len(table):
        return at, np.zeros(len(values), dtype=bool)
    at[at == len(table)] = 0
    return at, table[at] == values


class Units:
    """The clustered units: END, frequent words, word shapes, and the rest."""

    def __init__(self, core: np.ndarray, endings: np.ndarray):
        self.core, self.endings = np.sort(core), np.sort(endings)
        self.number = 2 + len(core) + len(endings)

    def of(self, words: np.ndarray, forms: np.ndarray) -> np.ndarray:
        at, found = _lookup(self.core, words)
        form, known = _lookup(self.endings, forms)
        rare = np.where(known, 1 + len(self.core) + form, self.number - 1)
        return np.where(found, 1 + at, rare)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    words, forms, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    distinct, first, inverse = np.unique(words, return_index=True, return_inverse=True)
    return distinct, forms[first], np.bincount(inverse, n, len(distinct)).astype(np.int64)


def _count(batches: Batches) -> Batches:
    """(word, form, n): the words of a task's texts."""
    parts, rows = [], 0

    def out() -> pa.RecordBatch:
        words, forms, n = _merged(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(forms), pa.array(n)], ["word", "form", "n"]
        )

    for batch in batches:
        for _, words, forms, _ in tokens.shaped_blocks(tokens.utf8(batch.column(0))):
            parts = [_merged([*parts, (words, forms, np.ones(len(words), dtype=np.int64))])]
            if len(parts[0][0]) > MERGE_ROWS:
                yield out()
                parts = []
    if parts:
        yield out()


def _sequence(unit: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units of several texts with an end behind each, and where the words are."""
    place = np.arange(len(unit)) + np.repeat(np.arange(len(counts)), counts)
    line = np.full(len(unit) + len(counts), END)
    line[place] = unit
    return line, place


def _pairs(docs: DataFrame, units: Units) -> np.ndarray:
    """How often each unit follows each, a start counting as an end."""
    n = units.number

    def count(batches: Batches) -> Batches:
        total = np.zeros(n * n, dtype=np.int64)
        for batch in batches:
            for _, words, forms, counts in tokens.shaped_blocks(tokens.utf8(batch.column(0))):
                line, _ = _sequence(units.of(words, forms), counts)
                code = np.append(END, line[:-1]) * n + line
                total += np.bincount(code, minlength=n * n)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], ["code", "n"])

    rows = docs.select("text").mapInArrow(count, "code long, n long")
    table = rows.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(n * n)
    pairs[table["code"].to_numpy()] = table["n"].to_numpy()
    return pairs.reshape(n, n)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int | None = None) -> np.ndarray:
    """The class of each unit. END keeps a class of its own; each other unit in
    turn goes to the class with the greatest sum of n log n over class pairs, less
    n log n of the classes, which is the log-likelihood up to a constant."""
    n = len(pairs)
    k = min(classes, max(2, n))
    total = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = [u for u in np.argsort(-total, kind="stable") if u != END]
    owner = np.zeros(n, dtype=np.int64)
    owner[order] = 1 + np.arange(len(order)) % (k - 1)
    member = np.zeros((n, k))
    member[np.arange(n), owner] = 1
    joint = member.T @ pairs @ member
    left, right = joint.sum(axis=1), joint.sum(axis=0)
    h = lambda x: x * np.log(np.maximum(x, 1))
    for _ in itertools.count() if sweeps is None else range(sweeps):
        moved = 0
        for u in order:
            if not total[u]:
                continue
            was, self_ = owner[u], pairs[u, u]
            member[u, was] = 0
            out, into = pairs[u] @ member, pairs[:, u] @ member
            lose_out, lose_in = out.sum() + self_, into.sum() + self_
            joint[was] -= out
            joint[:, was] -= into
            joint[was, was] -= self_
            left[was] -= lose_out
            right[was] -= lose_in
            # What row and column c of the class pairs gain if u goes to c.
            rows = (h(joint + out) - h(joint)).sum(axis=1)
            columns = (h(joint + into[:, None]) - h(joint)).sum(axis=0)
            own = np.diagonal(joint)
            both = h(own + out + into + self_) - h(own + out) - h(own + into) + h(own)
            ends = h(left + lose_out) - h(left) + h(right + lose_in) - h(right)
            gain = rows + columns + both - ends
            gain[END] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[was] + 1e-9:
                new = was
            moved += new != was
            owner[u] = new
            member[u, new] = 1
            joint[new] += out
            joint[:, new] += into
            joint[new, new] += self_
            left[new] += lose_out
            right[new] += lose_in
        if not moved:
            break
    return owner


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _beside(docs: DataFrame, units: Units, owner: np.ndarray, k: int) -> DataFrame:
    """word, packed: how often a word outside the core has a seed class before it
    (code below k) or behind it; packed is (seed * 2k + code, count)."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        words, codes = (np.concatenate(x) for x in zip(*parts, strict=True))
        distinct, inverse = np.unique(words, return_inverse=True)
        width = 2 * k * k
        key, n = np.unique(inverse * width + codes, return_counts=True)
        packed = (key % width << COUNT_BITS) + n
        return pa.RecordBatch.from_arrays(
            [pa.array(distinct[key // width].view(np.int64)), pa.array(packed)], ["word", "packed"]
        )

    def count(batches: Batches) -> Batches:
        parts, rows = [], 0
        for batch in batches:
            for _, words, forms, counts in tokens.shaped_blocks(tokens.utf8(batch.column(0))):
                unit = units.of(words, forms)
                line, place = _sequence(owner[unit], counts)
                other = np.flatnonzero(unit > len(units.core))
                at, seed = place[other], owner[unit[other]] * (2 * k)
                before = np.append(END, line[:-1])[at]
                parts += [(words[other], seed + before), (words[other], seed + k + line[at + 1])]
                rows += 2 * len(other)
                if rows > MERGE_ROWS:
                    yield merged(parts)
                    parts, rows = [], 0
        if rows:
            yield merged(parts)

    return docs.select("text").mapInArrow(count, "word long, packed long")


def best_classes(
    start: np.ndarray, seed: np.ndarray, code: np.ndarray, n: np.ndarray, joint: np.ndarray
) -> np.ndarray:
    """The class of each word whose rows begin at `start`: the one with the greatest
    gain of likelihood, all else as in the seed and the word out of its own class."""
    k = len(joint)
    beside = np.concatenate((joint, joint.T))  # by code: pairs with each class of the word
    kinds, inverse = np.unique(code * (1 << COUNT_BITS) + n, return_inverse=True)
    kind, times = kinds >> COUNT_BITS, (kinds & ((1 << COUNT_BITS) - 1)).astype(float)
    table = _h(beside[kind] + times[:, None]) - _h(beside[kind])
    rows = np.diff(np.append(start, len(code)))
    gain = np.add.reduceat(table[inverse], start, axis=0)
    size = np.add.reduceat(np.where(code >= k, n, 0), start).astype(float)
    left, right = joint.sum(axis=1), joint.sum(axis=0)
    sizes, at = np.unique(size, return_inverse=True)
    ends = sum(_h(x + sizes[:, None]) - _h(x) for x in (left, right))
    gain -= ends[at]
    own = beside[code, np.repeat(seed, rows)]
    stay = np.add.reduceat(_h(own) - _h(np.maximum(own - n, 0)), start)
    stay -= sum(_h(x[seed]) - _h(np.maximum(x[seed] - size, 0)) for x in (left, right))
    gain[np.arange(len(start)), seed] = stay
    gain[:, END] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[np.arange(len(start)), best] > stay + 1e-9, best, seed)


def _classed(beside: DataFrame, joint: np.ndarray) -> DataFrame:
    """word, class, n of every training word outside the core."""
    k = len(joint)

    def assign(word: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
        key, n = packed >> COUNT_BITS, packed & ((1 << COUNT_BITS) - 1)
        first = np.ones(len(word), dtype=bool)  # partial counts of a word and code
        first[1:] = (word[1:] != word[:-1]) | (key[1:] != key[:-1])
        at = np.flatnonzero(first)
        word, key, n = word[at], key[at], np.add.reduceat(n, at)
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        code, seed = key % (2 * k), key[start] // (2 * k)
        class_ = best_classes(start, seed, code, n, joint)
        size = np.add.reduceat(np.where(code >= k, n, 0), start)
        return pa.RecordBatch.from_arrays(
            [pa.array(word[start]), pa.array(class_.astype(np.int32)), pa.array(size)],
            ["word", "class", "n"],
        )

    def run(batches: Batches) -> Batches:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 2
        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(2)]
            word, packed = (np.concatenate(x) for x in zip(held, new, strict=True))
            if not len(word):
                continue
            last = np.searchsorted(word, word[-1])
            if last:
                yield assign(word[:last], packed[:last])
            held = [word[last:], packed[last:]]
        if len(held[0]):
            yield assign(*held)

    key, n = F.shiftright("packed", COUNT_BITS), F.col("packed").bitwiseAND((1 << COUNT_BITS) - 1)
    summed = beside.groupBy("word", key.alias("key")).agg(F.sum(n).alias("n"))
    packed = (F.shiftleft("key", COUNT_BITS) + F.col("n")).alias("packed")
    dealt = summed.select("word", packed).repartition("word").sortWithinPartitions("word", "packed")
    return dealt.mapInArrow(run, "word long, class int, n long")


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)
LABELLED = (
    "doc_id long, held_out boolean, n_tokens long, known long, base double, log_c double, "
    "line binary"
)


def _lines(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of a batch's documents with an end behind each, where the words
    are, and the number of words of each document."""
    blobs = batch.column(column)
    counts = np.array([len(x.as_py()) for x in blobs], dtype=np.int64)
    classes = np.frombuffer(b"".join(x.as_py() for x in blobs), dtype=np.uint8)
    line, place = _sequence(classes.astype(np.int64), counts)
    return line, place, counts


def _fill(batches: Batches) -> Batches:
    """Writes the classes of joined words (class, places) into the last but one column."""
    for batch in batches:
        lines = []
        for blob, found in zip(batch.column(6), batch.column(7), strict=True):
            line = np.frombuffer(blob.as_py(), dtype=np.uint8)
            if len(found):
                line = line.copy()
                places = found.values.field("places")
                times = places.value_lengths().to_numpy()
                class_ = found.values.field("class").to_numpy()
                line[places.flatten().to_numpy()] = np.repeat(class_, times)
            lines.append(line.tobytes())
        columns = [*batch.columns[:6], pa.array(lines, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in LABELLED.split(", ")])


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held_out = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out, F.coalesce("text", F.lit("")).alias("text")
    )
    training = rows.filter("NOT held_out")
    counted = training.select("text").mapInArrow(_count, "word long, form int, n long")
    counts = cut(
        counted.groupBy("word").agg(F.min("form").alias("form"), F.sum("n").alias("n"))
    )
    n_docs = training.count()
    words_n, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_train, n_distinct = words_n + n_docs, distinct + (n_docs > 0)
    common = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    common_word = common["word"].to_numpy().view(np.uint64)
    common_n, common_form = common["n"].to_numpy(), common["form"].to_numpy()
    top = np.lexsort((common_word, -common_n))[:CORE]
    # Shapes of the words that are not frequent enough to be units themselves.
    core = {int(x) for x in common_word[top].view(np.int64)}
    by_form = counts.filter(~F.col("word").isin(list(core))) if core else counts
    forms = by_form.groupBy("form").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "form")
    endings = np.array([r.form for r in forms.limit(ENDINGS).collect()], dtype=np.int32)
    units = Units(common_word[top], endings)
    pairs = _pairs(training, units)
    owner = exchange(pairs)
    k = int(owner.max()) + 1
    member = np.zeros((len(owner), k))
    member[np.arange(len(owner)), owner] = 1
    table = cut(_classed(_beside(training, units, owner, k), member.T @ pairs @ member))
    core_word = common_word[top]
    core_class = owner[units.of(core_word, common_form[top])]
    class_n, class_v = np.zeros(k), np.zeros(k)
    np.add.at(class_n, core_class, common_n[top])
    np.add.at(class_v, core_class, 1)
    for class_, n, distinct in table.groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        class_n[class_] += n
        class_v[class_] += distinct
    class_n[END], class_v[END] = n_docs, n_docs > 0
    chance = (class_n + 1) / (class_n.sum() + k)
    whole = n_train + SMOOTH * (n_distinct + 1)
    of_class = class_n + SMOOTH * (class_v + 1)
    more = table.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    frequent = np.append(core_word, more["word"].to_numpy().view(np.uint64))
    frequent_n = np.append(common_n[top], more["n"].to_numpy())
    frequent_class = np.append(core_class, more["class"].to_numpy()).astype(np.int64)
    sort = np.argsort(frequent)
    frequent, frequent_n, frequent_class = frequent[sort], frequent_n[sort], frequent_class[sort]

    def label(batches: Batches) -> Batches:
        log_n, log_whole = np.log10(frequent_n + SMOOTH), np.log10(whole)
        log_end = np.log10(n_docs + SMOOTH)
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            uid = batch.column(0).to_numpy()
            for first, words, forms, counts in tokens.shaped_blocks(
                tokens.utf8(batch.column(3))
            ):
                m = len(counts)
                doc = np.repeat(np.arange(m), counts)
                at, found = _lookup(frequent, words)
                class_ = owner[units.of(words, forms)]
                class_[found] = frequent_class[at[found]]
                log_c = np.where(found, log_n[at] if len(log_n) else 0.0, 0.0)
                base = np.bincount(doc, np.where(found, log_c - log_whole, 0), m)
                base += log_end - log_whole
                total = np.bincount(doc, log_c, m)
                known = np.bincount(doc, found, m).astype(np.int64) + (n_docs > 0)
                own = uid[first : first + m]
                begin = np.append(0, np.cumsum(counts))
                blob = class_.astype(np.uint8).tobytes()
                lines = [blob[x:y] for x, y in itertools.pairwise(begin)]
                rare = np.flatnonzero(~found)
                pair = np.lexsort((words[rare], doc[rare]))
                word, of = words[rare][pair], doc[rare][pair]
                new = np.ones(len(word), dtype=bool)
                new[1:] = (word[1:] != word[:-1]) | (of[1:] != of[:-1])
                run = np.flatnonzero(new)
                places = (rare[pair] - begin[of]).astype(np.int32)
                tail = len(run)
                # A row for each document, under a word of its own, then one for
                # each of its rare words.
                none = pa.nulls(tail, pa.float64())
                heads = batch.slice(first, m)
                starts = np.append(np.zeros(m, np.int64), np.append(run, len(word)))
                columns = [
                    pa.array(np.concatenate((own, own[of[run]]))),
                    pa.array(
                        np.concatenate((tokens.mix(own.view(np.uint64)), word[run])).view(np.int64)
                    ),
                    pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(places)),
                    pa.concat_arrays([heads.column(1), pa.nulls(tail, pa.int64())]),
                    pa.concat_arrays([heads.column(2), pa.nulls(tail, pa.bool_())]),
                    pa.concat_arrays([pa.array(counts + 1), pa.nulls(tail, pa.int64())]),
                    pa.concat_arrays([pa.array(known), pa.nulls(tail, pa.int64())]),
                    pa.concat_arrays([pa.array(base), none]),
                    pa.concat_arrays([pa.array(total), none]),
                    pa.array(lines + [None] * tail, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        "uid long, word long, places array<int>, doc_id long, held_out boolean, "
        "n_tokens long, known long, base double, log_c double, line binary"
    )
    numbered = rows.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "held_out", "text"
    )
    found = numbered.mapInArrow(label, schema).join(table, "word", "left")
    rare = F.size("places") > 0
    times = F.size("places")
    log_c = F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))
    sums = found.select(
        "uid",
        "doc_id",
        "held_out",
        "n_tokens",
        F.when(rare, F.when(F.col("n") > 0, times).otherwise(0))
        .otherwise(F.col("known"))
        .alias("known"),
        F.when(rare, times * (log_c - F.lit(float(np.log10(whole)))))
        .otherwise(F.col("base"))
        .alias("base"),
        F.when(rare, times * log_c).otherwise(F.col("log_c")).alias("log_c"),
        "line",
        F.when(rare & F.col("class").isNotNull(), F.struct("class", "places")).alias("found"),
    )
    labelled = (
        sums.groupBy("uid")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum("known").alias("known"),
            F.sum("base").alias("base"),
            F.sum("log_c").alias("log_c"),
            F.first("line", ignorenulls=True).alias("line"),
            F.collect_list("found").alias("found"),
        )
        .drop("uid")
    )
    labelled = cut(labelled.mapInArrow(_fill, LABELLED))

    def follow(batches: Batches) -> Batches:
        total = np.zeros(k * k, dtype=np.int64)
        for batch in batches:
            line, *_ = _lines(batch, 0)
            total += np.bincount(np.append(END, line[:-1]) * k + line, minlength=k * k)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], ["code", "n"])

    moves = labelled.filter("NOT held_out").select("line").mapInArrow(follow, "code long, n long")
    joint = np.zeros(k * k)
    for code, n in moves.groupBy("code").agg(F.sum("n")).collect():
        joint[code] = n
    joint = joint.reshape(k, k)
    step = (joint + BACK_OFF * chance) / (joint.sum(axis=1, keepdims=True) + BACK_OFF)
    step = np.log10(step)

    def score(batches: Batches) -> Batches:
        log_class, log_end = np.log10(of_class), np.log10(n_docs + SMOOTH)
        for batch in batches:
            line, place, counts = _lines(batch, 6)
            m = len(counts)
            moves = step[np.append(END, line[:-1]), line]
            total = np.bincount(np.repeat(np.arange(m), counts + 1), moves, m)
            total -= np.bincount(np.repeat(np.arange(m), counts), log_class[line[place]], m)
            total += batch.column(5).to_numpy() + log_end - log_class[END]
            n = pa.array(np.full(m, n_train, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], n, batch.column(4), pa.array(total)],
                [x.split()[0] for x in SCORES.split(", ")],
            )

    return labelled.mapInArrow(score, SCORES)


def op4_class_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))
