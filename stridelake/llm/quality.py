"""Quality rules: word perplexity under a modified Kneser-Ney model of the corpus, with bands for each language.

The model is of pairs: a word after the class of the word before it. Classes are 2**16 hash values of (language, word), so
a table of contexts is bounded whatever the vocabulary; predicted words are all words of the corpus, and pair counts grow
with it. Every occurrence of a pair is dealt to one of two folds by the hash of the four words around it, and judged by the
model of the other fold. So neither the text itself nor any copy, exact or near, vouches for it: where they agree they
fall into the same fold. Probabilities of all known words and the unknown one add up to 1 after any context.

* Counting. Tasks count pairs in blocks and hand over sorted arrays for each shard (a hash range of predicted words). A
  shard adds them up and stores them as a sorted hash array: pair hashes, counts of both folds. Beside it lie totals and
  numbers of pairs seen once, twice and more often by context, and how many contexts its words follow (their lower order).
  These are vectors of the number of classes, summed up as a tree; discounts and context weights follow from them and
  are broadcast.
* Scoring. Tasks hand over blocks of (pair hash, text of the block, count), sorted, for each shard, where they meet the
  stored array; sums by text and block come back.

The number of shards follows from the size of the texts (``SHARD_BYTES``), so a task's memory does not grow with the corpus.
Words that a bounded sample shows to be frequent are spread over all shards by pair, and their lower order is added up
from the reports; the sample decides where counts lie, never what they are.

Perplexity is per word, the end included. A language's band lies around its median logarithm, ``WIDTH`` times the quartile
distances to either side: what is below is repetitive, what is above garbled, both go. Medians are taken over all
documents that pass the base rules, from a histogram of fixed steps.

NULL or empty texts have no words, fail the base rules and have no perplexity; a NULL language is a language of its
own; texts are read whole, however long; repeated rows count and are judged like any other; extra columns pass through
``assess``, whatever their names but its results', which it replaces. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.common import SPACE, bucketed, give_back, steps, stored
from stridelake.llm.minhash import _mix

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Width of the bands in quartile distances, and histogram step (the least width), both of the perplexity's logarithm.
WIDTH, STEP = 7.0, 0.001
#: Bits of a context class, and of a predicted word's hash within its shard.
CLASS_BITS, WORD_BITS = 16, 32
#: Text of a shard, pairs of a block, documents of a block at most (their numbers take two bytes).
SHARD_BYTES, BLOCK, BLOCK_DOCS = 16 << 20, 1_500_000, 1 << 16
#: Bytes of texts that are hashed together, and texts that a task holds at a time.
PIECE_BYTES, ARROW_ROWS = 1 << 18, 1000
#: Folders of the stored model at most; each holds whole shards.
MOST_BUCKETS = 10_000
#: Parts of one in which a text's sum of logarithms comes back from a shard.
QUANTA = 256
#: Share of the words of a sample of ``SAMPLE_BYTES`` from which a word is spread over the shards.
FREQUENT, SAMPLE_BYTES = 0.002, 16 << 20

_SPACE = SPACE.encode()
_TAILS = bytes(range(0x80, 0xC0))  # bytes of a character after its first
_SYMBOLS = b"#*$%&|<>"
_EDGE = np.uint64(1)  # before the first and after the last word
_FOLDS, _CLASSES = 2, 1 << CLASS_BITS
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# --- base rules ---


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.split() if text else []
    if not words:
        return 0, 0, len(text or b"") - len((text or b"").translate(None, _SYMBOLS)), 0, 0
    chars = len(text.translate(None, _SPACE + _TAILS))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        if len(number) < 2**21:
            window = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        else:  # pairs are numbered first, so that any length fits
            _, pair = np.unique((ids[:-1] << 32) | ids[1:], return_inverse=True)
            window = (pair[:-1].astype(np.int64) << 32) | ids[2:]
        ordered = np.sort(window)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(again):
            hit = np.isin(window, again)
            covered = np.zeros(len(words), bool)
            for k in range(3):
                covered[k : len(window) + k] |= hit
            repeated = int(covered.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


# --- hashes ---


@dataclass(frozen=True)
class Layout:
    """Where pairs lie. Pair hashes hold the word's bits, its context's class and the fold, from high to low."""

    shards: int
    frequent: tuple[int, ...] = ()  # word hashes, ascending

    @property
    def bits(self) -> int:
        return min(63 - CLASS_BITS, WORD_BITS + max(self.shards - 1, 0).bit_length())

    def words(self, mixed: np.ndarray) -> np.ndarray:
        return mixed >> np.uint64(64 - self.bits)

    def is_frequent(self, word: np.ndarray) -> np.ndarray:
        return np.isin(word, np.array(self.frequent, np.uint64)) if self.frequent else np.zeros(len(word), bool)

    def shard(self, key: np.ndarray) -> np.ndarray:
        """Ranges of the word's hash; a frequent word's pairs by the hash of the pair."""
        word = key >> np.uint64(CLASS_BITS + 1)
        place = word >> np.uint64(self.bits - 32)
        often = self.is_frequent(word)
        place[often] = _mix(key[often] >> np.uint64(1)) >> np.uint64(32)
        return ((place * np.uint64(self.shards)) >> np.uint64(32)).astype(np.int32)


class WordHashes:
    """Hashes of all words of many texts at once: of the bytes' random numbers times powers of an odd number, prefix sums
    give every word's sum, and the power at its start is divided out."""

    def __init__(self):
        rng = np.random.default_rng(20)
        self.number = rng.integers(0, 1 << 64, 256, np.uint64)
        self.factor = int(rng.integers(0, 1 << 62)) * 4 + 3
        self.blank = np.zeros(256, bool)
        self.blank[np.frombuffer(_SPACE, np.uint8)] = True
        self.powers = self.inverse = np.ones(1, np.uint64)
        self.langs: dict[bytes, int] = {}

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("powers", self.factor), ("inverse", pow(self.factor, -1, 1 << 64))):
                out = np.full(n, base, np.uint64)
                out[0] = 1
                setattr(self, name, np.cumprod(out, dtype=np.uint64))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words between ``offsets``, and how many each text has. A long text is taken piece by piece."""
        if len(offsets) == 2 and len(data) > 2 * PIECE_BYTES:
            found, at = [], 0
            while at < len(data):
                end = min(at + PIECE_BYTES, len(data))
                while end < len(data) and not (near := self.blank[data[end : end + PIECE_BYTES]]).any():
                    end = min(end + PIECE_BYTES, len(data))
                if end < len(data):
                    end += int(near.argmax())
                found.append(self._words(data[at:end], np.array([0, end - at]))[0])
                at = end
            hashes = np.concatenate(found)
            return hashes, np.array([len(hashes)])
        return self._words(data, offsets)

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self._grow(len(data) + 1)
        letter = np.append(~self.blank[data], False)
        before = np.append(False, letter[:-1])
        border = np.zeros(len(letter), bool)
        border[offsets] = True
        starts, ends = np.flatnonzero(letter & (~before | border)), np.flatnonzero(before & (~letter | border))
        sums = np.zeros(len(letter), np.uint64)
        np.cumsum(self.number[data] * self.powers[: len(data)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * self.inverse[starts]
        return hashes, np.diff(np.searchsorted(starts, offsets))

    def pairs(self, langs: Sequence[bytes], data: np.ndarray, offsets: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        """One hash for each word and end, with its context, text by text, and how many each text has. The lowest bit is the
        fold, by the words from two before to one after."""
        hashes, n = self.words(data, offsets)
        for lang in set(langs).difference(self.langs):
            own = np.frombuffer(lang, np.uint8)
            self.langs[lang] = int(_mix(np.array([self._words(own, np.array([0, len(own)]))[0].sum() + np.uint64(len(own))]))[0])
        place = np.arange(len(n))
        lang = np.array([self.langs[x] for x in langs], np.uint64)
        padded = np.full(len(hashes) + 4 * len(n), _EDGE, np.uint64)
        padded[np.arange(len(hashes)) + np.repeat(4 * place + 2, n)] = _mix(hashes ^ np.repeat(lang, n))
        around = padded[:-3]
        for k in range(1, 4):
            around = _mix(around + padded[k : len(padded) - 3 + k] * np.uint64(2 * k + 1))
        at = np.arange(len(hashes) + len(n)) + np.repeat(3 * place + 2, n + 1)
        context = _mix(padded[at - 1]) >> np.uint64(64 - CLASS_BITS)
        return (layout.words(padded[at]) << np.uint64(CLASS_BITS + 1)) | (context << np.uint64(1)) | (around[at - 2] & np.uint64(1)), n + 1


def _planes(values: np.ndarray, kind: type) -> bytes:
    """Bytes of equal weight side by side, which a compressor shortens where they are alike."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T.tobytes()


def _values(data: bytes, at: int, n: int, kind: type) -> tuple[np.ndarray, int]:
    size = np.dtype(kind).itemsize
    out = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T
    return np.ascontiguousarray(out).view(kind).ravel(), at + n * size


def packed(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """Sorted hashes as differences, and 32-bit numbers beside them; shorter than what Spark's own codec makes of it."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _short(_planes(steps, np.uint64) + b"".join(_planes(v, np.uint32) for v in values))


def _short(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _long(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    data = _long(data)
    n = len(data) // (8 + 4 * columns)
    steps, at = _values(data, 0, n, np.uint64)
    out = [np.cumsum(steps, dtype=np.uint64)]
    for _ in range(columns):
        values, at = _values(data, at, n, np.uint32)
        out.append(values)
    return out


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])


def _by_shard(keys: np.ndarray, layout: Layout) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Order of sorted ``keys`` by shard, and each shard's part of it."""
    shard = layout.shard(keys)
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cuts = _runs(shard)
    return order, [(int(shard[a]), slice(a, b)) for a, b in zip(cuts, [*cuts[1:], len(shard)])]


# --- corpus ---


def _language():
    return F.coalesce("lang", F.lit(""))


def _handle():
    """Perplexity is a function of language and text: copies share a handle, and their sums have the same mean."""
    return F.xxhash64(_language(), F.col("text"))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("binary").alias("text")
    return docs.select(_language().cast("binary").alias("lang"), text, _handle().alias("doc")).where("text is not null and octet_length(text) > 0")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Languages, bytes of the texts, where each begins and ends, handles: about ``PIECE_BYTES`` or one text at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(1)
        places = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, 4 * text.offset)
        data = np.frombuffer(text.buffers()[2], np.uint8)
        handles = batch.column(2).to_numpy()
        at = 0
        while at < len(text):
            end = min(max(at + 1, int(np.searchsorted(places, int(places[at]) + PIECE_BYTES, "right")) - 1), at + BLOCK_DOCS)
            yield (batch.column(0).slice(at, end - at).to_pylist(), data[places[at] : places[end]], places[at : end + 1].astype(np.int64) - places[at],
                   handles[at:end])
            at = end


def layout_of(docs: DataFrame) -> Layout:
    """Shards by the size of the texts; frequent words from a sample whose size does not grow with them."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    layout = Layout(max(1, -(-size // SHARD_BYTES)))
    if layout.shards == 1:
        return layout
    sample = _texts(docs.sample(min(1.0, SAMPLE_BYTES / size), seed=7))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for langs, data, offsets, _ in _slices(batches):
            keys, _ = hashes.pairs(langs, data, offsets, layout)
            word, n = np.unique(keys >> np.uint64(CLASS_BITS + 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    counts = sample.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = F.sum("n").alias("total")
    often = counts.join(F.broadcast(counts.agg(total))).where(F.col("n") > FREQUENT * F.col("total"))  # one line; at most 1 / FREQUENT words
    return Layout(layout.shards, tuple(sorted(r["word"] for r in often.select("word").collect())))


# --- counts ---

def _times(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4."""
    found = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)
    return [int(x) for x in found[1:5]]


#: Numbers of a fold's summary: pairs seen once to four times; words that follow one to four classes; pairs, words and words
#: that follow three classes or more. Frequent words are left out of all but the first.
SUMMARY = 4 + 4 + 3


def _reports(pair: np.ndarray, counts: list[np.ndarray], layout: Layout) -> tuple[np.ndarray, list[int], list[tuple[int, ...]]]:
    """Of one shard: by fold and class the total and the pairs seen once, twice, more often; the folds' summaries; frequent
    words with the classes that they follow in each fold."""
    word, context = pair >> np.uint64(CLASS_BITS), (pair & np.uint64(_CLASSES - 1)).astype(np.int64)
    starts = _runs(word)
    own = word[starts]
    often = layout.is_frequent(own)
    by_class, summary, followers = np.zeros((_FOLDS, 4, _CLASSES), np.int64), [], []
    for fold, c in enumerate(counts):
        by_class[fold] = [np.bincount(context, c, _CLASSES), *[np.bincount(context[at], minlength=_CLASSES) for at in (c == 1, c == 2, c > 2)]]
        follows = np.add.reduceat(c > 0, starts, dtype=np.int64)
        known = follows[~often]
        summary += [*_times(c), *_times(known), int(known.sum()), int((known > 0).sum()), int((known > 2).sum())]
        followers.append(follows[often])
    return by_class, summary, [(int(w), int(a), int(b)) for w, a, b in zip(own[often], *followers)]


def counted(docs: DataFrame, layout: Layout) -> DataFrame:
    """The model's shards, stored: ``shard, model`` (pairs and their counts in both folds, sorted), ``by_class, summary, often``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, held = WordHashes(), [], 0

        def block() -> pa.RecordBatch:
            keys = np.concatenate(waiting)
            waiting.clear()
            keys.sort()
            starts = _runs(keys)
            n = np.diff(np.append(starts, len(keys))).astype(np.uint32)
            keys = keys[starts]
            del starts
            order, parts = _by_shard(keys, layout)
            return pa.RecordBatch.from_pydict({"shard": pa.array([x for x, _ in parts], pa.int32()), "data": pa.array([packed(keys[order[p]], n[order[p]]) for _, p in parts])})

        for langs, data, offsets, _ in _slices(batches):
            waiting.append(hashes.pairs(langs, data, offsets, layout)[0])
            held += len(waiting[-1])
            if held >= BLOCK:
                yield block()
                held = 0
        if held:
            yield block()
        give_back()

    def shard(own: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(data, 1) for data in own["data"]]
        keys = np.concatenate([k for k, _ in parts])
        n = np.concatenate([n for _, n in parts])
        del parts
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        n = n[order].astype(np.int64)
        del order
        starts = _runs(keys >> np.uint64(1))
        fold = (keys & np.uint64(1)) == 1
        counts = [np.add.reduceat(np.where(fold == f, n, 0), starts) for f in (False, True)]
        pair = keys[starts] >> np.uint64(1)
        by_class, summary, often = _reports(pair, counts, layout)
        lines = [dict(zip(("word", "a", "b"), x)) for x in often]
        del keys, n, starts, fold
        give_back()
        return pd.DataFrame({"shard": [own["shard"].iloc[0]], "model": [packed(pair, *counts)], "by_class": [_short(_planes(by_class.ravel(), np.int64))],
                             "summary": [summary], "often": [lines]})

    dealt = _texts(docs).mapInArrow(blocks, "shard int, data binary")
    schema = "shard int, model binary, by_class binary, summary array<bigint>, often array<struct<word:bigint,a:bigint,b:bigint>>"
    return bucketed(dealt.groupBy("shard").applyInPandas(shard, schema), "model", "shard", min(layout.shards, MOST_BUCKETS), ARROW_ROWS)


def _class_totals(shards: DataFrame) -> np.ndarray:
    """The shards' vectors added up: by the tasks that read them, then in groups, then those."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for data in batch["by_class"]:
                own = _values(_long(data), 0, _FOLDS * 4 * _CLASSES, np.int64)[0]
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"by_class": [_short(_planes(total, np.int64))]})

    vectors = shards.select("by_class")
    for tasks in (None, 64, 1):
        vectors = (vectors if tasks is None else vectors.repartition(tasks)).mapInPandas(add, "by_class binary")
    found = vectors.collect()  # one vector, of 2 * 4 numbers a class
    return _values(_long(bytes(found[0]["by_class"])), 0, _FOLDS * 4 * _CLASSES, np.int64)[0].reshape(_FOLDS, 4, _CLASSES) if found else np.zeros((_FOLDS, 4, _CLASSES), np.int64)


# --- probabilities ---


def discounts(times: Sequence[int]) -> np.ndarray:
    """Modified Kneser-Ney's, by count 0, 1, 2 and more, from how often counts 1 to 4 occur. Where those do not occur, half the
    count; always less than the count."""
    n1, n2, n3, n4 = times
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *[min(max(d, 0.1), i - 0.05) for i, d in enumerate(raw, 1)]])


@dataclass
class Fold:
    """What the words of one fold say about a word and its context."""

    totals: np.ndarray  # by class
    weights: np.ndarray  # by class: what is left to the lower order
    pair_cut: np.ndarray
    word_cut: np.ndarray
    followed: int  # pairs, which are what the lower order counts
    unknown: float  # probability of a word that the fold does not have; of known ones it is the share of the uniform part

    def lower(self, follows: np.ndarray) -> np.ndarray:
        if not self.followed:
            return np.full(len(follows), self.unknown)
        return (follows - self.word_cut[np.minimum(follows, 3)]) / self.followed + self.unknown

    def probability(self, context: np.ndarray, count: np.ndarray, follows: np.ndarray) -> np.ndarray:
        total, low = self.totals[context], self.lower(follows)
        high = (count - self.pair_cut[np.minimum(count, 3)]) / np.maximum(total, 1)
        return np.where(total > 0, high + self.weights[context] * low, low)


def folds(shards: DataFrame) -> tuple[list[Fold], dict[int, tuple[int, int]]]:
    """Both folds, and by frequent word how many classes it follows in each. What reaches the driver is bounded by the number
    of classes and of frequent words."""
    totals = _class_totals(shards)
    sums = shards.select(F.posexplode("summary")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    summary = np.zeros(_FOLDS * SUMMARY, np.int64)
    summary[[r["pos"] for r in sums]] = [r["n"] for r in sums]
    lines = shards.select(F.inline("often")).groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    often = {r["word"]: (r["a"], r["b"]) for r in lines}
    out = []
    for fold, own in enumerate(summary.reshape(_FOLDS, SUMMARY)):
        frequent = np.array([n[fold] for n in often.values()], np.int64)
        pair_cut, times = discounts(own[:4]), own[4:8] + np.array(_times(frequent))
        word_cut = discounts(times)
        followed, known, many = own[8:] + np.array([frequent.sum(), (frequent > 0).sum(), (frequent > 2).sum()])
        left = word_cut[1] * times[0] + word_cut[2] * times[1] + word_cut[3] * many
        weights = pair_cut[1:] @ totals[fold][1:] / np.maximum(totals[fold][0], 1)
        out.append(Fold(totals[fold][0].astype(float), weights, pair_cut, word_cut, int(followed), float(left / followed if followed else 1.0) / (int(known) + 1)))
    return out, often


# --- scores ---


class Shard:
    """A stored shard, to be looked up."""

    def __init__(self, model: bytes, layout: Layout, often: dict[int, tuple[int, int]]):
        self.pair, *self.counts = unpacked(model, _FOLDS)
        word = self.pair >> np.uint64(CLASS_BITS)
        starts = _runs(word)
        self.nth = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(word))))
        own = word[starts]
        frequent = layout.is_frequent(own)
        self.follows = []
        for fold, c in enumerate(self.counts):
            n = np.add.reduceat(c > 0, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
            n[frequent] = [often[int(w)][fold] for w in own[frequent]]
            self.follows.append(n)

    def logs(self, keys: np.ndarray, both: list[Fold]) -> np.ndarray:
        """Logarithms of the probabilities that the other fold gives."""
        at = np.searchsorted(self.pair, keys >> np.uint64(1))
        context = (self.pair[at] & np.uint64(_CLASSES - 1)).astype(np.int64)
        fold = (keys & np.uint64(1)).astype(np.int64)
        out = np.empty(len(keys))
        for f, judge in ((0, 1), (1, 0)):
            own = fold == f
            out[own] = np.log(both[judge].probability(context[own], self.counts[judge][at[own]].astype(np.int64), self.follows[judge][self.nth[at[own]]]))
        return out


def word_logs(docs: DataFrame, layout: Layout, shards: DataFrame) -> DataFrame:
    """``(doc, log_ppl)``: mean negative logarithm of the probability of a text's words, the end included."""
    found, often = folds(shards)
    shared = docs.sparkSession.sparkContext.broadcast(([vars(f) for f in found], often))  # plain values: no class to import

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes, waiting, lengths, handles, number = WordHashes(), [], [], [], TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            keys, length = np.concatenate(waiting), np.concatenate(lengths)
            waiting.clear()
            doc = np.repeat(np.arange(len(length), dtype=np.uint32), length)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            doc = doc[order]
            del order
            same = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])))
            n = np.diff(np.append(same, len(keys))).astype(np.uint32)
            keys, doc = keys[same], doc[same]
            del same
            order, parts = _by_shard(keys, layout)
            rows = [(x, number, packed(keys[order[p]], doc[order[p]], n[order[p]])) for x, p in parts]
            # the texts' handles and lengths travel with one of the shards and pass it
            rows.append((parts[0][0], -1 - number, np.concatenate(handles).astype(np.int64).tobytes() + length.astype(np.int64).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], ["shard", "block", "data"])

        held = texts = 0
        for langs, data, offsets, own in _slices(batches):
            if texts + len(own) > BLOCK_DOCS or held >= BLOCK:
                yield block()
                waiting, lengths, handles, held, texts, number = [], [], [], 0, 0, number + 1
            found, n = hashes.pairs(langs, data, offsets, layout)
            for into, values in ((waiting, found), (lengths, n), (handles, own)):
                into.append(values)
            held, texts = held + len(found), texts + len(own)
        if held:
            yield block()
        give_back()

    def scored(entries: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        known, often = shared.value
        both = [Fold(**f) for f in known]
        own, out = Shard(model["model"].iloc[0], layout, often), []
        for block, data in zip(entries["block"], entries["data"]):
            if block >= 0:
                keys, doc, n = unpacked(data, 2)
                sums = -np.bincount(doc, n * own.logs(keys, both))
                texts = np.flatnonzero(np.bincount(doc))
                data = packed(texts.astype(np.uint64), np.rint(sums[texts] * QUANTA))
            out.append((block, data))
        del own
        give_back()
        return pd.DataFrame(out, columns=["block", "data"])

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        heads = parts[parts["block"] < 0]["data"].iloc[0]
        handles, lengths = np.frombuffer(heads, np.int64).reshape(2, -1)
        sums = np.zeros(len(handles))
        for block, data in zip(parts["block"], parts["data"]):
            if block >= 0:
                texts, quanta = unpacked(data, 1)
                sums[texts.astype(np.int64)] += quanta
        return pd.DataFrame({"doc": handles, "logs": sums / QUANTA, "n": lengths})

    dealt = _texts(docs).mapInArrow(blocks, "shard int, block long, data binary")
    sums = dealt.groupBy("shard").cogroup(shards.select("shard", "model").groupBy("shard")).applyInPandas(scored, "block long, data binary")
    of_block = F.when(F.col("block") < 0, -1 - F.col("block")).otherwise(F.col("block"))
    sums = sums.withColumn("of", of_block).groupBy("of").applyInPandas(added, "doc long, logs double, n long")
    return stored(sums.groupBy("doc").agg((F.sum("logs") / F.sum("n")).alias("log_ppl")), "word_logs", ARROW_ROWS)


# --- verdict ---


def assess(docs: DataFrame, width: float = WIDTH, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the base counts, ``perplexity``, its language's band ``lower``, ``upper``, ``base_failed`` and ``kept``.

    The measured rows are stored once, with the columns in ``carry`` (all, unless given).
    """
    results = [*NAMES, "perplexity", "lower", "upper", "base_failed", "kept"]
    columns = [c for c in (carry if carry is not None else docs.columns) if c not in results]
    layout = layout_of(docs)
    with steps() as keep:  # the model goes when the texts are scored
        logs = keep(word_logs(docs, layout, counted(docs, layout)))

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    def measure(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([base_counts(t) for t in text], columns=NAMES)

    # the caller's columns travel in one struct, so that none of them can clash with those here
    measured = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), _language().alias("lang"), _handle().alias("doc"),
                           measure(F.col("text").cast("binary")).alias("m"))
    failed = (F.col("m.n_words") < MIN_WORDS) | (100 * F.col("m.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("m.n_words"))
    measured = stored(measured.withColumn("failed", failed), "measured", ARROW_ROWS).join(logs, "doc", "left")
    step = F.round(F.col("log_ppl") / STEP).cast("int").alias("step")
    histogram = measured.where("not failed and log_ppl is not null").groupBy("lang", step).agg(F.count(F.lit(1)).alias("n"))
    quarters = F.percentile("step", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q")
    bands = histogram.groupBy("lang").agg(quarters).select(
        "lang",
        (F.col("q")[1] * STEP - F.greatest((F.col("q")[1] - F.col("q")[0]) * STEP * width, F.lit(STEP))).alias("low"),
        (F.col("q")[1] * STEP + F.greatest((F.col("q")[2] - F.col("q")[1]) * STEP * width, F.lit(STEP))).alias("high"))
    judged = measured.join(stored(bands, "bands"), "lang", "left")  # of known size: one line for each language
    inside = F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(True))
    return judged.select("row.*", *[F.col(f"m.{n}").alias(n) for n in NAMES], F.col("failed").alias("base_failed"),
                         (~F.col("failed") & inside).alias("kept"), F.exp("log_ppl").alias("perplexity"),
                         F.exp("low").alias("lower"), F.exp("high").alias("upper"))
