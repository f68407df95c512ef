"""Alignment of two tokenizers over the same texts, on Arrow arrays.

The texts of a chunk are cut at single blanks between other characters. Neither vocabulary has a token that continues over
such a blank, so a text's tokens are those of its words (this is checked when the vocabularies are loaded; where it does
not hold, a text is one word), and a word is encoded once for many texts. The chunk's ids are one list array each:
flattened, with parent indices; the byte lengths of the ids are summed up and each text's start taken off, which gives
every token's end; (text, end) is one number, on which an Acero hash join finds the tokens that end together; a group-by
of that join counts each text's id pairs. Spark merges these partial counts over the corpus and joins them back to the
texts, by broadcast only where its own size check allows, else by a shuffle; a pair that a third of all texts hold is one
row for each of them there.

A text longer than ``CHUNK_CHARS`` is aligned piece by piece, cut at such blanks too; one without any is one piece.

A text has no tokens, and zeros for all counts, if it is NULL or empty or if the bytes of either tokenizer's tokens are not a
blank and the text. Repeated rows and ids are texts of their own; only the carried columns are returned, so others may have
any name; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.common import stored

#: Characters of texts that are taken together, and of the pieces of a long one.
CHUNK_CHARS = 1 << 20
#: Words whose ids a task remembers, and their characters, before it starts afresh.
CACHE_WORDS, CACHE_CHARS = 300_000, 8 << 20
#: Bits of the end within a text; the text's place stands above them.
END_BITS = 40
_CUT = re.compile(r"(?<=\S) (?=\S)")
_OTHER_BLANKS = re.compile(r"\s\s")
_PAIRS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))
FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable characters stand for themselves, the other bytes for those from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class _Numbers(dict):
    """Words by the order in which they came."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Tokenizers:
    """Both tokenizers with the bytes of their ids. ``a`` is a byte-level file, ``b`` a model that puts a blank in front."""

    def __init__(self, a: str, b: str):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        letters, vocabulary = _byte_letters(), self.a.get_vocab(with_added_tokens=False)
        spelt_a = [b""] * (1 + max(chain(vocabulary.values(), self.a.get_vocab().values())))
        for token, i in vocabulary.items():
            spelt_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        spelt_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [pa.array(s, pa.binary()) for s in (spelt_a, spelt_b)]
        self.lengths = [pc.binary_length(s).cast(pa.int64()) for s in self.bytes]
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces) and self.a.normalizer is None
        # each id with what may follow it: another of its side, the other side, the next group, nothing
        ends = [(",", "|"), (",", ";", "")]
        self.shown = pa.array([f"{i}{e}" for s, side in zip((spelt_a, spelt_b), ends) for i in range(len(s)) for e in side], pa.string())
        self.first_b = 2 * len(spelt_a)

        self.forget()

    def forget(self) -> None:
        self.numbers, self.chars, self.good = _Numbers(), 0, np.zeros(0, bool)
        self.ids = [pa.array([], pa.list_(pa.int32()))] * 2

    def words(self, text: str) -> list[str]:
        if not self.separable or not text:
            return [text] if text else []
        if text[0] == " " or text[-1] == " " or _OTHER_BLANKS.search(text):
            return _CUT.split(text)
        return text.split(" ")

    def numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the texts' words, one text after the other, and how many each text has. New words are encoded together."""
        if len(self.numbers) >= CACHE_WORDS or self.chars >= CACHE_CHARS:
            self.forget()
        before, words = len(self.numbers), [self.words(t) for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, counts.sum())
        new = list(islice(reversed(self.numbers), len(self.numbers) - before))[::-1]
        if new:
            self.chars += sum(map(len, new))
            in_a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in new], add_special_tokens=False)]
            found = [_flat(in_a), _flat(self.b.encode(new, num_threads=1))]
            want = [b" " + w.encode() for w in new]
            good = _spells(found[0], self.bytes[0], want) & _spells(found[1], self.bytes[1], want)
            self.good = np.concatenate([self.good, good])
            self.ids = [pa.concat_arrays([known, f]) for known, f in zip(self.ids, found)]
        return codes, counts

    def pieces(self, text: str) -> list[str]:
        if len(text) <= CHUNK_CHARS or not self.separable:
            return [text]
        out, at = [], 0
        while (cut := _CUT.search(text, at + CHUNK_CHARS)) is not None:
            out.append(text[at : cut.start()])
            at = cut.end()
        return [*out, text[at:]]


class Chunk:
    """Alignment of some texts: counts by text, the id pairs ``(text, a, b, n)`` and the groups as written."""

    def __init__(self, both: Tokenizers, texts: list[str]):
        codes, n_words = both.numbered(texts)
        owner = np.repeat(np.arange(len(texts)), n_words)
        self.good = (n_words > 0) & (np.bincount(owner[~both.good[codes]], minlength=len(texts)) == 0)
        if not self.good.all():
            codes, n_words = codes[self.good[owner]], n_words * self.good
        starts, sides = np.concatenate([[0], np.cumsum(n_words)]), []
        for known in both.ids:
            taken = known.take(pa.array(codes))
            sides.append(pa.ListArray.from_arrays(taken.offsets.take(pa.array(starts)), pc.list_flatten(taken)))
        (ids_a, key_a), (ids_b, key_b) = [_ends(s, n) for s, n in zip(sides, both.lengths)]
        left = pa.table({"key": key_a, "a": ids_a})
        links = left.join(pa.table({"key": key_b, "b": ids_b}), "key", join_type="inner", use_threads=False).combine_chunks()
        text = pc.shift_right(links["key"], END_BITS)
        pairs = pa.table({"text": text, "a": links["a"], "b": links["b"]}).group_by(["text", "a", "b"], use_threads=False).aggregate([([], "count_all")])
        self.pairs = pairs.rename_columns(["text", "a", "b", "n"]).sort_by("text").combine_chunks()
        common = np.sort(links["key"].to_numpy(), kind="stable")
        common = common[np.append(True, common[1:] != common[:-1])[: len(common)]]
        per = lambda values: np.bincount(values, minlength=len(texts)).astype(np.int64)
        self.counts = np.stack([pc.list_value_length(s).to_numpy().astype(np.int64) for s in sides]
                               + [per(common >> END_BITS), per(text.to_numpy())], axis=1)
        self.groups = _written(both, ids_a, key_a, ids_b, key_b, common, len(texts))


def _flat(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])))


def _spells(side: pa.ListArray, spelt: pa.Array, want: list[bytes]) -> np.ndarray:
    """Which texts' ids spell the wanted bytes."""
    taken = spelt.take(pc.list_flatten(side))
    at = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, 4 * taken.offset)[side.offsets.to_numpy()].tolist()
    data = memoryview(taken.buffers()[2] or b"").cast("B")
    return np.array([data[a:b] == w for a, b, w in zip(at, at[1:], want)], bool)


def _ends(side: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Flat ids, and of each the text's place and its end in bytes as one number."""
    ids, parents = pc.list_flatten(side), pc.list_parent_indices(side)
    total = pc.cumulative_sum(lengths.take(ids))
    before = np.concatenate([[0], total.to_numpy()])[side.offsets.to_numpy()[:-1]]  # at each text's start
    end = pc.subtract(total, pa.array(before).take(parents))
    return ids, pc.bit_wise_or(pc.shift_left(parents.cast(pa.int64()), END_BITS), end)


def _written(both: Tokenizers, ids_a: pa.Array, key_a: pa.Array, ids_b: pa.Array, key_b: pa.Array, common: np.ndarray, n: int) -> pa.Array:
    """``a1,a2|b1;a3|b2`` of each text: both sides' tokens are put in the order of their groups, and the strings of ids with
    what follows them taken in one go; a text's groups are then a slice of the result's bytes."""
    a, b, key_a, key_b = (x.to_numpy() for x in (ids_a, ids_b, key_a, key_b))
    group_a, group_b = np.searchsorted(common, key_a), np.searchsorted(common, key_b)
    in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
    place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
    last = lambda x: np.append(x[1:] != x[:-1], True)[: len(x)]
    codes = np.empty(len(a) + len(b), np.int64)
    codes[place_a] = 2 * a + last(group_a)
    codes[place_b] = both.first_b + 3 * b + last(group_b) + last(key_b >> END_BITS)
    shown = both.shown.take(pa.array(codes))
    tokens = np.concatenate([[0], np.cumsum(np.bincount(key_a >> END_BITS, minlength=n) + np.bincount(key_b >> END_BITS, minlength=n))])
    at = np.frombuffer(shown.buffers()[1], np.int32, len(shown) + 1)[tokens]
    return pa.StringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(at, np.int32).tobytes()), shown.buffers()[2])


class _Long:
    """One long text, piece by piece."""

    def __init__(self, both: Tokenizers, text: str, keep: bool):
        self.good, self.counts, digest, shown, pairs = True, np.zeros(len(FIELDS), np.int64), hashlib.sha256(), [], []
        for i, piece in enumerate(both.pieces(text)):
            chunk = Chunk(both, [piece])
            self.good = self.good and bool(chunk.good[0])
            if not self.good:
                break
            self.counts += chunk.counts[0]
            shown.append(chunk.groups[0].as_py() if keep else "")
            digest.update((";" * bool(i) + chunk.groups[0].as_py()).encode())
            pairs.append(chunk.pairs.select(["a", "b", "n"]))
            if len(pairs) == 16:
                pairs = [_merged(pairs)]
        self.pairs, self.digest, self.shown = _merged(pairs) if pairs else None, digest.hexdigest(), ";".join(shown)
        if not self.good:
            self.counts[:], self.pairs, self.digest, self.shown = 0, None, "", ""


def _merged(pairs: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(pairs).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
    return both.rename_columns(["a", "b", "n"])


def align(docs: DataFrame, a: str, b: str, carry: Sequence[str] = ("doc_id",), text: str = "text", groups: bool = False) -> DataFrame:
    """Each text's counts ``n_a, n_b, n_groups, n_links``, the digest of its groups, its id pairs ``pairs array<struct<a, b,
    n>>``, and ``row``, a number of its own; with ``groups`` also the groups as written. ``a`` and ``b`` name tokenizer files."""
    names = [f"c{i}" for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        both = Tokenizers(a, b)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            at, texts = 0, batch.column(len(names))
            sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy()
            while at < batch.num_rows:
                end, size = at + 1, sizes[at]
                while end < batch.num_rows and size + sizes[end] <= CHUNK_CHARS:
                    size += sizes[end]
                    end += 1
                own = [t or "" for t in texts.slice(at, end - at).to_pylist()]
                head = [batch.column(i).slice(at, end - at) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*head, pa.array(np.arange(row, row + end - at)), *columns(both, own)], out)
                row += end - at
                at = end

    def columns(both: Tokenizers, texts: list[str]) -> list[pa.Array]:
        if len(texts) == 1 and len(texts[0]) > CHUNK_CHARS:
            long = _Long(both, texts[0], groups)
            counts, digests, shown = long.counts[None, :], [long.digest], [long.shown]
            table = long.pairs
            offsets = [0, 0 if table is None else table.num_rows]
        else:
            chunk = Chunk(both, texts)
            counts, table = chunk.counts, chunk.pairs
            shown = chunk.groups.to_pylist() if groups else None
            digests = [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(shown or chunk.groups.to_pylist(), counts[:, 0])]
            offsets = np.searchsorted(table["text"].to_numpy(), np.arange(len(texts) + 1))
        if table is None:
            pairs = pa.array([[]], _PAIRS)
        else:
            fields = [table[c].combine_chunks().cast(t) for c, t in (("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()))]
            pairs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["a", "b", "n"]))
        return [*[pa.array(np.ascontiguousarray(counts[:, i])) for i in range(len(FIELDS))], pa.array(digests, pa.string()),
                *([pa.array(shown, pa.string())] if groups else []), pairs]

    out = [*names, "row", *FIELDS, "groups_sha256", *["groups"] * groups, "pairs"]
    schema = ", ".join([*[f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, carry)], "row long", *[f"{f} long" for f in FIELDS],
                        "groups_sha256 string", *["groups string"] * groups, "pairs array<struct<a:int,b:int,n:bigint>>"])
    slim = docs.select(*[F.col(c).alias(n) for c, n in zip(carry, names)], F.col(text).cast("string").alias("t"))
    return slim.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(names, carry)], *out[len(names):])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, n, best``: in how many links of the corpus the pair stands, and whether none of its ``b`` stands in more."""
    counts = aligned.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").alias("n"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(aligned: DataFrame) -> DataFrame:
    """``aligned`` (a stored table) with ``n_best`` and ``count_sum``: links whose pair is its ``b``'s most frequent one, and
    the counts of all links' pairs added up."""
    known = pair_counts(aligned).select("a", "b", F.col("n").alias("count"), "best")
    own = aligned.select("row", F.inline("pairs")).join(known, ["a", "b"])
    sums = own.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
                                  F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return aligned.join(sums, "row", "left").select(*[c for c in aligned.columns if c not in ("row", "pairs")], zero("n_best"), zero("count_sum"))
