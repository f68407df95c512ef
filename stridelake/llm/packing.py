"""Best-fit packing of token pieces, after Martello-Toth dominance reduction.

Piece lengths lie between 1 and the capacity, so the instance is a histogram of at most ``capacity`` lengths, however
many documents there are. The plan is made on that histogram: the reduction fixes sets that provably dominate every
other set with the same piece, the rest is packed best-fit, longest first. A plan line says how many sequences share a
pattern; its size depends on the capacity alone. Pieces find their place by their rank within their length, which is
counted per stored partition, so equal lengths (a third of all rows, say) need no single task.

Reduction, for a piece j with the free room r = capacity - j, on what remains (i is the longest piece that fits):

* nothing fits: {j};  i fills the room, or no two pieces fit: {j, i};
* no three fit and i is at least as long as the fullest two: {j, i};
* no three fit and {i, b} fits, where no pair holds a shorter piece above b: {j, i, b}.

Each alternative for j can be put into the set's places, so some best packing holds the set. The conditions stay true
while copies of the set are removed, so copies are fixed together.

Empty and NULL texts are the end token alone; repeated rows and ids are packed like any other row (``doc_id`` may be
NULL); other columns are ignored; an empty table packs nothing.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.llm.common import give_back, stored

CAPACITY, END = 2048, 0
#: Words that a task remembers before it starts afresh, and their ids.
CACHE_WORDS, CACHE_IDS = 500_000, 10_000_000
#: Bytes of texts whose words are looked up together; a longer text is taken in parts, cut at white space.
WINDOW_BYTES = 1_000_000
#: Bytes of ids whose pieces are handed on together.
HELD_BYTES = 1_000_000
#: The tokenizer's steps before its model; and what its pattern finds in plain words, lower-cased.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_UNITS = re.compile(r"'(?:[stmd]|re|ve|ll)|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f]+")
#: Plain words: printable ASCII and the letters of Latin-1 and Latin Extended-A. Each such letter is composed already,
#: and its small letter (but that of the dotted capital I) is one of them too.
_PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")

#: Kinds of UTF-8 bytes. A plain word is cut where the kind changes and around each digit; one with a ``WHOLE`` byte stays
#: whole: the apostrophe (its endings depend on what is before it) and what no plain word has.
BLANK, LETTER, SIGN, DIGIT, WHOLE = range(5)
_BLANKS = b" \t\n\x0b\f\r"
_KINDS = bytes(
    BLANK if c in _BLANKS else DIGIT if 0x30 <= c <= 0x39 else LETTER if chr(c).isalpha() and c < 0x80 or 0x80 <= c < 0xC0 or 0xC3 <= c <= 0xC5
    else SIGN if 0x21 <= c <= 0x7E and c != 0x27 else WHOLE for c in range(256))
_WORDS_ONLY = bytes(BLANK if c in _BLANKS else WHOLE for c in range(256))
_LOWER = bytes(range(256)).lower()
#: The characters of the lead bytes C3 to C5: both bytes of the small letter, and which are in no plain word.
_TWO = [chr(c) for c in range(0xC0, 0x180)]
_SMALL = np.array([list((x.lower() if _PLAIN.match(x) else x).encode()) for x in _TWO], np.uint8)
_ODD = np.array([not _PLAIN.match(x) for x in _TWO])


# --- tokens ---


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``first``, ``first + 1``, ... of each line, ``size`` of them."""
    end = np.cumsum(size)
    return np.repeat(first - end + size, size) + np.arange(end[-1] if len(end) else 0)


def _units(raw: bytes, ends: np.ndarray, kinds: bytes) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """What the pattern finds in texts that lie one after the other, lower-cased; which of it are whole words; and how many
    lie before each end. Words that are not plain, with an apostrophe or the start of an added token come whole, as they are.
    """
    data, kind = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(kinds), np.uint8)
    inner = ends[ends < len(raw)]
    begins = np.ones(len(raw), bool)
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    begins |= kind == DIGIT
    begins[inner] = True
    at = np.flatnonzero(begins)
    filled = kind[at] != BLANK
    first = np.ones(len(at), bool)  # of its word
    np.logical_not(filled[:-1], out=first[1:])
    first[np.searchsorted(at, inner)] = True
    small = np.frombuffer(bytearray(raw.translate(_LOWER)), np.uint8)
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    two = (data[lead] - 0xC3).astype(np.intp) * 64 + (data[lead + 1] - 0x80)
    small[lead], small[lead + 1] = _SMALL[two].T
    added = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    inside = np.zeros(len(at), bool)
    spots = np.concatenate([np.flatnonzero(kind == WHOLE), lead[_ODD[two]], added])
    if len(spots):
        word = np.cumsum(first & filled)
        whole = np.zeros(len(at) + 1, bool)
        whole[word[np.searchsorted(at, spots, "right") - 1]] = True
        inside = whole[word] & filled
        stay = first | ~inside
        at, filled, inside = at[stay], filled[stay], inside[stay]
        own = _ranges(at[inside], np.diff(at, append=len(raw))[inside])
        small[own] = data[own]
    offsets = np.zeros(np.count_nonzero(filled) + 1, np.int32)
    np.cumsum(np.diff(at, append=len(raw))[filled], out=offsets[1:])
    found = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(small[kind != BLANK]))
    return found, inside[filled], np.searchsorted(at[filled], ends)


class _WordIds(dict):
    """Numbers of the words, and of the parts that the pattern finds, whose ids stand one after the other in ``ids``. The
    tokenizer splits at white space and drops it, so a text's ids are its words' ids one after the other."""

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.model = tokenizer, tokenizer.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        # the model knows each UTF-8 byte as a character
        self.spelt = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x180)}
        steps = [json.loads(x.__getstate__()) if x else None for x in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
        self.known = steps == [NORMALIZER, PRE_TOKENIZER]
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.ids, self.ends = array("I"), array("q")

    def _learn(self, word: str, ids: list[int]) -> None:
        self[word] = len(self)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))

    def _part(self, part: str) -> list[int]:
        """Ids of what the pattern finds, from the tokenizer's model alone."""
        return [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.spelt))]

    def _learn_words(self, words: list[str]) -> None:
        """Normalising leaves plain words as they are but for the case, so these, added tokens apart, are cut here and go
        to the model; all others, and those of other tokenizers, go through the whole."""
        plain = [w for w in words if _PLAIN.fullmatch(w) and "<|" not in w] if self.known else []
        for word in plain:
            self._learn(word, list(chain.from_iterable(map(self._part, _UNITS.findall(word.lower())))))
        other = [w for w in words if w not in self]
        for word, found in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self._learn(word, found.ids)

    def _numbers(self, words: list[str], whole: np.ndarray) -> np.ndarray:
        """Numbers of different words; those that are new are encoded."""
        if len(self) >= CACHE_WORDS or len(self.ids) >= CACHE_IDS:
            self.clear()
        numbers = np.fromiter(map(self.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        parts, new = new[~whole[new]], new[whole[new]].tolist()
        numbers[parts] = np.arange(len(self), len(self) + len(parts))
        for at in parts.tolist():
            self._learn(words[at], self._part(words[at]))
        self._learn_words([words[at] for at in new])
        numbers[new] = [self[words[at]] for at in new]
        return numbers

    def _ids(self, raw: bytes, ends: np.ndarray) -> tuple[bytes, list[int]]:
        """Ids of texts that lie one after the other, and where each text's end among their bytes. Each different word is
        looked up once."""
        found, whole, before = _units(raw, ends, _KINDS if self.known else _WORDS_ONLY)
        if not len(found):
            return b"", [0] * len(ends)
        coded = found.dictionary_encode()
        code = coded.indices.to_numpy()
        uncut = np.zeros(len(coded.dictionary), bool)
        uncut[code] = whole
        numbers = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), uncut)
        last = np.frombuffer(self.ends, np.int64)[numbers]
        size = last - np.where(numbers > 0, np.frombuffer(self.ends, np.int64)[numbers - 1], 0)
        each = size[code]
        taken = np.frombuffer(self.ids, np.uint32)[_ranges((last - size)[code], each)].astype("<u4", copy=False)
        return taken.tobytes(), (4 * np.concatenate([[0], np.cumsum(each)])[before]).tolist()

    def texts(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """Ids of each text, a window of texts at a time."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string()).fill_null("")
        if not len(texts):
            return
        texts.validate(full=True)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at, ends, row = int(ends[0]), ends[1:], 0
        parts: list[bytes] = []  # of a text longer than a window
        while row < len(texts):
            upto = int(np.searchsorted(ends, at + WINDOW_BYTES, "right"))
            if upto > row:
                stop = int(ends[upto - 1])
            else:
                stop = _cut(data, at, int(ends[row]))
                upto = row + (stop == ends[row])
            ids, cuts = self._ids(bytes(data[at:stop]) if stop > at else b"", ends[row:upto] - at)
            for first, last in zip([0, *cuts], cuts):
                yield b"".join([*parts, ids[first:last]])
                parts = []
            if row == upto:
                parts.append(ids)
            at, row = stop, upto


def _cut(data: pa.Buffer, at: int, end: int) -> int:
    """Where to end the first window of a long text: after its last white space, or before the next one."""
    window = bytes(data[at : at + WINDOW_BYTES])
    last = max(window.rfind(c) for c in _BLANKS)
    if last >= 0:
        return at + last + 1
    after = re.compile(rb"[ \t-\r]").search(memoryview(data), at + WINDOW_BYTES, end)
    return after.start() if after else end


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    ``tokenizer`` names a file of the public tokenizers. ``_part`` and ``_rank`` say which of the task's pieces of
    that length it is.
    """

    def lines(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        from tokenizers import Tokenizer

        words = _WordIds(Tokenizer.from_file(public_tokenizers.path(tokenizer)))
        end = np.array([END], "<u4").tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, held = [], 0
            for doc_id, part, ids in zip(batch["doc_id"].to_pylist(), batch["_part"].to_pylist(), words.texts(batch["text"])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(own), part, seen[n], *([np.frombuffer(own, "<u4").astype(np.int32)] if with_ids else [])))
                    seen[n] += 1
                held += len(ids)
                if held >= HELD_BYTES:  # few ids are Python objects at a time
                    yield lines(rows)
                    rows, held = [], 0
            if rows:
                yield lines(rows)
        del words
        give_back()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, _part int, _rank long" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    types = [{"int": pa.int32(), "long": pa.int64()}.get(x.split()[1], pa.list_(pa.int32())) for x in schema.split(", ")]
    slim = docs.select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("_part"))
    return slim.mapInArrow(run, schema)


# --- plan, on the histogram ---


class _Left:
    """Lengths that remain, ascending, with their counts."""

    def __init__(self, counts: dict[int, int]):
        self.count = dict(counts)
        self.lengths = sorted(counts)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            self.lengths.remove(length)

    def longest(self, room: int) -> int | None:
        at = bisect_right(self.lengths, room)
        return self.lengths[at - 1] if at else None

    def smallest(self, n: int) -> list[int]:
        out: list[int] = []
        for x in self.lengths:
            out += [x] * min(n - len(out), self.count[x])
            if len(out) == n:
                break
        return out

    def partner(self, x: int, room: int) -> int | None:
        """Longest piece that fits beside a piece of length ``x``, which is not used twice."""
        at = bisect_right(self.lengths, room - x)
        while at:
            y = self.lengths[at - 1]
            if y != x or self.count[y] > 1:
                return y
            at -= 1
        return None


def _dominating(left: _Left, room: int) -> tuple[int, ...] | None:
    """The set that dominates all others which fill ``room``, if one provably does."""
    i = left.longest(room)
    if i is None:
        return ()
    least = left.smallest(3)
    if i == room or len(least) < 2 or sum(least[:2]) > room:
        return (i,)
    if len(least) == 3 and sum(least) <= room:
        return None
    fullest = second = 0
    for x in left.lengths:
        if x > room:
            break
        y = left.partner(x, room)
        if y is not None:
            fullest, second = max(fullest, x + y), max(second, min(x, y))
    if i >= fullest:
        return (i,)
    b = left.partner(i, room)
    if b is not None and b >= second:
        return (i, b)
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Lines ``(sequences, pattern)`` that use up the histogram; a pattern lists lengths, longest first."""
    left, lines = _Left(histogram), []
    changed = True
    while changed:
        changed = False
        for j in sorted(left.lengths, reverse=True):
            while left.count.get(j):
                left.count[j] -= 1  # j itself is no partner
                if not left.count[j]:
                    left.lengths.remove(j)
                chosen = _dominating(left, capacity - j)
                if not left.count[j]:
                    left.lengths.insert(bisect_right(left.lengths, j), j)
                left.count[j] += 1
                if chosen is None:
                    break
                need: dict[int, int] = {}
                for x in (j, *chosen):
                    need[x] = need.get(x, 0) + 1
                n = min(left.count[x] // k for x, k in need.items())
                for x, k in need.items():
                    left.take(x, n * k)
                lines.append((n, tuple(sorted((j, *chosen), reverse=True))))
                changed = True
    return lines + _best_fit({x: left.count[x] for x in left.lengths}, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit, longest first; sequences with the same content are handled together."""
    rooms: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    free: list[int] = []  # rooms with sequences, ascending

    def put(room: int, n: int, pattern: tuple[int, ...]) -> None:
        if room not in rooms:
            rooms[room] = []
            free.insert(bisect_right(free, room), room)
        rooms[room].append((n, pattern))

    for x in sorted(counts, reverse=True):
        todo = counts[x]
        while todo:
            at = bisect_right(free, x - 1)
            if at == len(free):
                fits = min(todo, capacity // x)
                n = todo // fits
                put(capacity - fits * x, n, (x,) * fits)
                todo -= n * fits
                continue
            room = free[at]
            n, pattern = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], free[at]
            fits = min(todo, room // x)
            used = min(n, todo // fits)
            if used < n:
                put(room, n - used, pattern)
            put(room - fits * x, used, pattern + (x,) * fits)
            todo -= used * fits
    return [line for lines in rooms.values() for line in lines]


# --- places ---


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` of their place."""
    cut = stored(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    per = cut.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n"))
    # one line for each length, at most ``capacity``
    histogram = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    starts: dict[int, list[tuple[int, int, int, int]]] = {}  # by length: first rank, pieces of it in a sequence, first sequence, offset
    used = dict.fromkeys(histogram, 0)
    sequence = 0
    for n, pattern in plan(histogram, capacity):
        at = 0
        for x in sorted(set(pattern), reverse=True):
            k = pattern.count(x)
            starts.setdefault(x, []).append((used[x], k, sequence, at))
            used[x] += n * k
            at += k * x
        sequence += n
    lines = {x: np.array(v, np.int64) for x, v in starts.items()}
    before = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    base = per.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = cut.join(base, ["_part", "length"]).withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_base", "_part")

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        out = np.zeros((len(rank), 2), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            line = lines[int(x)]
            line = line[np.searchsorted(line[:, 0], rank[at], "right") - 1]
            within = rank[at] - line[:, 0]
            out[at, 0] = line[:, 2] + within // line[:, 1]
            out[at, 1] = line[:, 3] + within % line[:, 1] * x
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*[c for c in cut.columns if c not in ("_part", "_rank")], "_place.sequence_id", "_place.offset")
