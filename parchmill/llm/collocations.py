"""Operator 11: phrases that occur more often than their parts foretell, by weighted acyclic automata.

Each shard of texts builds count transducers from its sorted n-grams.  They are
cut by prefix range (a hash of an n-gram's first words); each range's parts of
all shards are united, their weights summed, and only prefixes that reach the
threshold stay.  Parts of phrases are looked up by composing the counted
phrases with themselves: a join on the part.

Everything a phrase consists of is at least as frequent as the phrase.  So the
counts are made in three passes, words, pairs, and longer phrases, and a pass
leaves out n-grams of which a word or pair is known to be below the threshold.
What is known goes to the tasks as a bitmap of fixed size, in which a bit that
is set by chance only means more work.

Words are named by 64-bit hashes.  Every word of the corpus takes part in a test
for collisions; if there is one, the pass is run again with another seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize
from .transducer import Transducer, prefixes, sorted_sums, union

#: Occurrences that a phrase needs; its words at most; phrases kept per language.
LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text that one transducer is built from; words of the corpus per prefix range.
SHARD_BYTES, RANGE_WORDS = 8 << 20, 4_000_000
#: Bits of the bitmaps of words and of pairs.
WORD_BITS, PAIR_BITS = 24, 26
#: A sign that no word contains; all that end a piece become it.
END = b"."
_FOLD = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased, and END wherever a piece ends."""
    return text.translate(_FOLD).replace(END, b" . ").split()


def _mixed(*labels: np.ndarray) -> np.ndarray:
    """A 64-bit hash of columns of labels."""
    out = np.zeros(len(labels[0]), np.uint64)
    for label in labels:
        out = (out ^ label) * _MIX
        out ^= out >> np.uint64(29)
    return out * _MIX


def _cells(lang: str, bits: int, *labels: np.ndarray) -> np.ndarray:
    """Places of n-grams in a bitmap."""
    seed = np.full(len(labels[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    return (_mixed(seed, *labels) >> np.uint64(64 - bits)).astype(np.int64)


class Shards:
    """Cuts a partition's texts into shards of one language each: (lang, labels of the words, word number at each place or -1 at an end, words)."""

    def __init__(self, seed: int, shard_bytes: int):
        self.seed, self.shard_bytes = seed, shard_bytes

    def __call__(self, batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                while text:
                    room = self.shard_bytes - size.get(lang, 0)
                    cut = len(text) if len(text) <= room else self._cut(text, room)
                    held.setdefault(lang, []).append(text[:cut])
                    size[lang] = size.get(lang, 0) + cut
                    text = text[cut:]
                    if size[lang] >= self.shard_bytes:
                        yield self._shard(lang, held.pop(lang))
                        size[lang] = 0
                # Many languages don't add up beyond the bound either.
                if sum(size.values()) >= 2 * self.shard_bytes:
                    for each in list(held):
                        yield self._shard(each, held.pop(each))
                    size = {}
        for lang in list(held):
            yield self._shard(lang, held.pop(lang))

    def _cut(self, text: bytes, room: int) -> int:
        """A place near ``room`` where a piece ends, so that no phrase is lost; the text's end if there is none."""
        for at in range(max(room, 1) - 1, len(text)):
            if _FOLD[text[at]] == 46:
                return at + 1
        return len(text)

    def _shard(self, lang: str, texts: list[bytes]):
        coded = pa.array(tokens(END.join(texts)) + [END], pa.binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        labels = np.array([max(1, xxhash.xxh64_intdigest(w, self.seed)) for w in words], np.uint64)
        order = np.argsort(labels, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        end = place[words.index(END)]
        at = place[coded.indices.to_numpy()]
        at[at == end] = -1
        return lang, labels[order], at, [words[k] for k in order], int(end)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _word_counts(docs: DataFrame, seed: int, least: int, shard_bytes: int) -> DataFrame:
    """(lang, label, word, other, f): words with f >= least, all words that share a label (word != other), and f of all words under a null label."""
    shards = Shards(seed, shard_bytes)

    def run(batches):
        for lang, labels, at, words, end in shards(batches):
            f = np.bincount(at[at >= 0], minlength=len(words))
            total = int(f.sum())
            for k in range(0, len(words) + 1, 50_000):
                part = slice(k, k + 50_000)
                label, word, n = labels[part].view(np.int64), words[part], f[part]
                if k == 0:
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([total])], names)
                yes = n > 0
                yield pa.RecordBatch.from_arrays([pa.array([lang] * int(yes.sum()), pa.string()), pa.array(label[yes]), pa.array([w for w, y in zip(word, yes) if y], pa.binary()), pa.array(n[yes])], names)

    names = ["lang", "label", "word", "f"]
    each = _texts(docs).mapInArrow(run, "lang string, label long, word binary, f long")
    sums = each.groupBy("lang", "label").agg(F.min("word").alias("word"), F.max("word").alias("other"), F.sum("f").alias("f"))
    return sums.where((F.col("f") >= least) | F.col("label").isNull() | (F.col("word") != F.col("other")))


def _bitmap(spark: SparkSession, frequent: DataFrame, columns: list[str], bits: int) -> np.ndarray:
    """Bits of the n-grams in ``frequent``; 2^bits bits whatever their number, so it can go to every task."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lang = np.asarray(batch.column(0).to_pylist(), object)
            labels = [batch.column(k + 1).to_numpy().view(np.uint64) for k in range(len(columns))]
            for x in set(lang):
                cell = _cells(x, bits, *[label[lang == x] for label in labels])
                block, number = np.unique(cell >> 6, return_inverse=True)
                word = np.zeros(len(block), np.uint64)
                np.bitwise_or.at(word, number, np.uint64(1) << (cell & 63).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(word.view(np.int64))], ["block", "word"])

    words = frequent.select("lang", *columns).mapInArrow(run, "block long, word long").groupBy("block").agg(F.bit_or("word").alias("word"))
    found, out = words.toArrow(), np.zeros(2**bits // 64, np.uint64)
    out[found.column("block").to_numpy()] = found.column("word").to_numpy().view(np.uint64)
    return out


def _has(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bitmap[cells >> 6] >> (cells & 63).astype(np.uint64)) & np.uint64(1) != 0


def _pairs(lang, labels, at, words_map, bits):
    """Distinct pairs (numbers of both words) of words that may be frequent, and per place which pair begins there (-1: none)."""
    may = np.append(_has(words_map, _cells(lang, bits, labels)), False)  # the last entry is for -1, an end
    begins = np.flatnonzero(may[at[:-1]] & may[at[1:]] & (at[:-1] >= 0) & (at[1:] >= 0))
    key, pair, f = np.unique(at[begins] * len(labels) + at[begins + 1], return_inverse=True, return_counts=True)
    number = np.full(len(at), -1, np.int64)
    number[begins] = pair
    return key // len(labels), key % len(labels), f, number


def _parts(lang: str, rows: np.ndarray, counts: np.ndarray, ranges: int, first: int):
    """A shard's sorted n-grams as one packed transducer per prefix range; the range is a hash of the ``first`` words."""
    number = (_mixed(*[rows[:, k] for k in range(first)]) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[order])) + 1
    out = [(int(number[part[0]]), Transducer.build(rows[part], counts[part]).pack()) for part in np.split(order, cuts) if len(part)]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out)), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["lang", "range", "packed"])


def _united(parts: DataFrame, least: int, shortest: int) -> DataFrame:
    """(lang, phrase, f) of all phrases of ``shortest`` words or more that occur ``least`` times; ``phrase`` are labels.

    A group is one range of one language: as many n-grams as RANGE_WORDS words have, copies summed as they come.
    """

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = (Transducer.unpack(x.as_py()) for batch in batches for x in batch.column("packed"))
        rows, counts = union(read)
        for d, (at, _, _, weight) in enumerate(prefixes(rows, counts)):
            yes = weight >= least
            if d + 1 >= shortest and yes.any():
                flat = pa.array(rows[at[yes], : d + 1].reshape(-1).view(np.int64))
                phrase = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, d + 1), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(phrase)), phrase, pa.array(weight[yes])], ["lang", "phrase", "f"])

    return parts.groupBy("lang", "range").applyInArrow(run, "lang string, phrase array<long>, f long")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_bytes: int = SHARD_BYTES, range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``longest`` words with f >= ``least``, and (lang, label, word, f) with the words (label null: all words)."""
    spark = docs.sparkSession
    for seed in count():
        words = materialize(_word_counts(docs, seed, least, shard_bytes), "words")
        if words.where("word != other").isEmpty():
            break
    total = words.where("label is null").agg(F.sum("f")).first()[0] or 0
    ranges = total // range_words + 1
    frequent = words.where("label is not null")
    shards = Shards(seed, shard_bytes)
    word_map = spark.sparkContext.broadcast(_bitmap(spark, frequent, ["label"], WORD_BITS))

    def pairs(batches):
        for lang, labels, at, _, _ in shards(batches):
            one, two, f, _ = _pairs(lang, labels, at, word_map.value, WORD_BITS)
            yield from _parts(lang, np.stack([labels[one], labels[two]], 1), f, ranges, 2)

    packed = "lang string, range long, packed binary"
    counted = materialize(_united(_texts(docs).mapInArrow(pairs, packed), least, 2), "pairs")
    both = counted.select("lang", F.col("phrase")[0].alias("one"), F.col("phrase")[1].alias("two"))
    pair_map = spark.sparkContext.broadcast(_bitmap(spark, both, ["one", "two"], PAIR_BITS))

    def longer(batches):
        for lang, labels, at, _, _ in shards(batches):
            one, two, _, number = _pairs(lang, labels, at, word_map.value, WORD_BITS)
            may = np.append(_has(pair_map.value, _cells(lang, PAIR_BITS, labels[one], labels[two])), False)[number]
            may = np.concatenate([may, np.zeros(longest, bool)])
            begins = np.flatnonzero(may[: len(at)] & may[1 : len(at) + 1])
            rows, on = np.zeros((len(begins), longest), np.int64), np.ones(len(begins), bool)
            for d in range(longest):
                on = on & may[begins + d - 1] if d else on
                rows[on, d] = at[begins[on] + d] + 1
            rows, f = sorted_sums(rows, np.ones(len(begins), np.int64))
            yield from _parts(lang, np.concatenate([[np.uint64(0)], labels])[rows], f, ranges, 3)

    counts = frequent.select("lang", F.array("label").alias("phrase"), "f").union(counted)
    if longest > 2:
        counts = counts.union(_united(_texts(docs).mapInArrow(longer, packed), least, 3))
    return materialize(counts, "phrases"), words


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, **sizes: int) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase has 2 to ``longest`` words inside one piece and occurs a >= ``least``
    times.  Cut after its first words it has parts that occur l and r times; the
    cut with the lowest floor(1000 a n / (l r)) counts, the first one on a tie,
    n being all words of the language.  Phrases that always are part of a
    longer phrase are left out.  Order: score and a descending, then phrase by bytes.

    Null languages are ``und``; null and empty texts have no phrases; repeated
    rows count each; other columns are ignored.  An empty table gives no rows.
    """
    counts, words = phrase_counts(docs, least, longest, **sizes)
    part = counts.select("lang", F.col("phrase").alias("part"), F.col("f"))
    m = F.size("phrase")
    cuts = counts.where(m > 1).select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), m - 1)).alias("k")).withColumns(
        {"left": F.slice("phrase", 1, F.col("k")), "rest": F.slice("phrase", F.col("k") + 1, longest)}
    )
    told = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]
    )
    told = materialize(told, "cuts")
    # A longer phrase of the same count that holds a phrase holds it together with the word before or behind it.
    inside = told.where((F.col("k") == 1) & (F.col("r") == F.col("a"))).select("lang", F.col("rest").alias("phrase")).union(
        told.where((F.size("rest") == 1) & (F.col("l") == F.col("a"))).select("lang", "left")
    ).distinct()
    n = words.where("label is null").select("lang", F.col("f").alias("n"))
    score = F.expr("cast((1000 * (cast(a as decimal(17,0)) * cast(n as decimal(17,0)))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long)")
    best = told.join(inside, ["lang", "phrase"], "left_anti").join(n, "lang").withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ).select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    # Ties at the end need the words, so they stay until the words are there.
    near = best.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("rank") <= top)
    spelt = near.select("*", F.posexplode("phrase").alias("at", "label")).join(words.where("label is not null").select("lang", "label", "word"), ["lang", "label"]).groupBy(
        "lang", "phrase", "a", "l", "r", "n", "score"
    ).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"].cast("string")), " ").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    ranked = spelt.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
