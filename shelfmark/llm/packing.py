"""Best-fit packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import codecs
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches, kept

CAPACITY = 2048
#: Rows of one length and task that share a place in the prefix sums.
CHUNK = 8192
#: Distinct words of which a worker remembers the ids after a batch, those used last; a batch with more
#: holds its own. All are looked up with each batch, so more of them cost more than they save.
REMEMBERED = 400_000
#: Words that go to the merges at once.
MERGED = 1024
#: Bytes of rows of which a worker looks up the words at once; a larger Arrow batch goes alone.
GATHERED = 8 << 20

#: Texts for which words can not be cut here just as the tokenizer cuts them: those with `<|`, or with
#: more than printable ASCII, tab, line ends, Latin letters and signs, usual punctuation. They go to
#: the tokenizer whole.
_NOT_PLAIN = r"<\||[^\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞€]"
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: A sign at the end of a word, a piece of its own: parted there, fewer words are distinct.
_LAST_SIGN = r"([\p{L}\p{N}])([.,;:!?)])(\s)"

#: Text on which words cut here must give the tokenizer's ids; else all texts go to the tokenizer whole.
_PROBE = "It's 42 naïve Größen, don't\tÉté_co-op €5 (x²) we'LL 'tis #1!\n\n\\end … — “q” ÿþ"

#: Merges work on a letter per byte: printable Latin-1 as it is, other bytes in turn from 256 on. The
#: blank, which no piece holds, stands for itself.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_LETTERS = "".join(
    chr(b) if b in _PRINTABLE or b == 32 else chr(256 + _OTHERS.index(b)) for b in range(256)
)


class WordIds:
    """Token ids of texts as little-endian 32-bit bytes, with the ids of words remembered.

    Pieces cut before the merges are independent, so ids of a text are those of its pieces in turn,
    and the pieces of a text those of its words between white space. Plain texts hold nothing that
    composing would change, and their lower case goes letter by letter. Arrow cuts the texts of a
    batch, numbers its words behind those remembered and puts the ids together; only words that are
    new meet Python.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.cut = regex.compile(_CUT).findall
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.used = np.zeros(0, dtype=np.int64)
        self.calls = 0
        self.not_plain = _NOT_PLAIN
        if self(pa.array([_PROBE])) != self._whole([_PROBE]):
            self.not_plain = ""

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; null: none."""
        texts = texts.fill_null("").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, self.not_plain)
        # The one letter here whose lower case is two.
        plain = pc.replace_substring(texts.filter(pc.invert(odd)), "İ", "i\u0307")
        parted = pc.replace_substring_regex(pc.utf8_lower(plain), _LAST_SIGN, r"\1 \2\3")
        words = pc.ascii_split_whitespace(parted)
        ids = type(words).from_arrays(words.offsets, self._ids_of(words.flatten()))
        cut = iter(pc.binary_join(ids, pa.scalar(b"", pa.large_binary())).to_pylist())
        whole = iter(self._whole(texts.filter(odd).to_pylist()))
        return [next(whole if o else cut) for o in odd.to_pylist()]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_as_bytes(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """Ids of each word; those that are new are encoded at once and remembered."""
        known = len(self.words)
        coded = pa.concat_arrays([self.words, words]).dictionary_encode()
        at, self.words = coded.indices[known:], coded.dictionary
        new = self.words[known:].to_numpy(zero_copy_only=False).tolist()
        parts = [self._encoded(new[k : k + MERGED]) for k in range(0, len(new), MERGED)]
        self.ids = pa.concat_arrays([self.ids, *parts])
        ids = self.ids.take(at)
        self.calls += 1
        self.used = np.append(self.used, np.zeros(len(new), dtype=np.int64))
        self.used[at.to_numpy()] = self.calls
        if len(self.words) > REMEMBERED:
            latest = np.sort(np.argpartition(self.used, -REMEMBERED)[-REMEMBERED:])
            self.words, self.ids, self.used = self.words.take(latest), self.ids.take(latest), self.used[latest]
        return ids

    def _encoded(self, words: list[str]) -> pa.Array:
        """Ids of each word: of all pieces in a row, cut behind the tokens that only end a piece."""
        rows = [w if w.isalpha() else " ".join(self.cut(w)) for w in words]
        spelled = codecs.charmap_decode(" ".join(rows).encode(), "strict", _BYTE_LETTERS)[0]
        (row,) = self.merges.encode_batch_fast([spelled], add_special_tokens=False)
        ids = np.array(row.ids, dtype="<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        pieces = np.cumsum([0, *(r.count(" ") + (r != "") for r in rows)])
        if len(ends) != pieces[-1]:
            one = self.tokenizer.model.tokenize
            each = [[t.id for t in one(piece)] for piece in spelled.split()]
            ids = np.array([i for piece in each for i in piece], dtype="<u4")
            ends = np.cumsum([len(piece) for piece in each], dtype=np.int64)
        stops = 4 * np.append(0, ends)[pieces]
        return pa.Array.from_buffers(
            pa.large_binary(), len(rows), [None, pa.py_buffer(stops), pa.py_buffer(ids)]
        )


def _as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def gathered(batches: Iterator[pa.RecordBatch], size: int = GATHERED) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches joined as far as they have no more than `size` bytes together."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if held and n + batch.nbytes > size:
            yield pa.concat_batches(held)
            held, n = [], 0
        held.append(batch)
        n += batch.nbytes
    if held:
        yield pa.concat_batches(held)


_WORD_IDS: dict[str, WordIds] = {}

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, chunk long, nth long"
)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """PIECES of each row's whole text: its ids and an end id 0, cut where longer than `capacity`.

    `nth` numbers pieces of one length within a task and chunk, for their rank among all.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer not in _WORD_IDS:
            _WORD_IDS[tokenizer] = WordIds(tokenizer)
        ids_of = _WORD_IDS[tokenizer]
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in gathered(batches):
            rows: list[tuple] = []
            for doc_id, data in zip(batch.column(0).to_pylist(), ids_of(batch.column(1))):
                data += b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    ids = data[at : at + 4 * capacity]
                    n = len(ids) // 4
                    chunk, nth = divmod(seen[n], CHUNK)
                    seen[n] += 1
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(ids), part, chunk, nth))
            columns = list(zip(*rows)) or [[]] * 8
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int64())
            names = [f.split()[0] for f in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, PIECES
    )


class Capacities:
    """Segment tree over remaining capacities: which have open bins, and the tightest that fits."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, at: int, value: bool) -> None:
        at += self.leaves
        self.any[at] = value
        while at > 1:
            at >>= 1
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        at = need + self.leaves
        if self.any[at]:
            return need
        # Up to the first right sibling with an open bin, then down its left edge.
        while at > 1 and (at & 1 or not self.any[at + 1]):
            at >>= 1
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit decreasing over documents counted by length: runs of documents that go alike.

    A run is (length, first rank, documents, documents per bin, first bin, offset in the bin). Equal
    documents meet bins of one capacity in a row: the tightest bin stays the tightest while it fits
    another, so it takes as many as it can before the next bin. The work and the plan depend on the
    number of lengths, not on that of documents.
    """
    tree, open_bins, runs = Capacities(capacity), {}, []
    bins = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            open_bins.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        todo, rank = counts[length], 0
        while todo:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, bins
                n = -(-todo // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    tree.set(room, False)
            per = room // length
            full = min(n, todo // per)
            if full:
                runs.append((length, rank, full * per, per, first, capacity - room))
                put(room - per * length, first, full)
                rank, todo = rank + full * per, todo - full * per
            if full < n and todo:
                runs.append((length, rank, todo, todo, first + full, capacity - room))
                put(room - todo * length, first + full, 1)
                full, todo = full + 1, 0
            put(room, first + full, n - full)
    return runs


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece of each document, with its sequence and its place there.

    Texts are read and tokenized once; from then on only rows of numbers move. Best-fit decreasing
    needs no more than how many pieces there are of each length: at most `capacity` rows reach the
    driver, where `best_fit_plan` packs them exactly as one run over all documents would. A piece
    finds its sequence by its rank among the pieces of its length, made of its place in its task
    and prefix sums over tasks, so nothing is sorted as a whole.

    Null or empty text: one piece, the end id. Repeated rows and null doc_ids are documents of
    their own. Extra columns are not read. An empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    pieces = kept(token_pieces(docs, tokenizer, capacity), "pieces")
    counts = pieces.groupBy("length", "part", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part", "chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = docs.sparkSession.createDataFrame(
        best_fit_plan({r["length"]: r["n"] for r in totals}, capacity),
        "length long, first_rank long, n long, per long, first_bin long, first_offset long",
    )
    ranked = pieces.join(before.drop("n"), ["length", "part", "chunk"]).withColumn(
        "rank", F.col("before") + F.col("nth")
    )
    # Its rows are bounded by the number of lengths, see best_fit_plan.
    placed = ranked.join(
        F.broadcast(runs),
        (ranked["length"] == runs["length"])
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("n")),
    )
    at = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("first_bin") + F.floor(at / F.col("per"))).alias("sequence_id"),
        (F.col("first_offset") + at % F.col("per") * ranked["length"]).alias("offset"),
    )
