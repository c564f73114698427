"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut where no piece can reach across, and parts not met before are put
end to end. A suffix array of this text is built, and every piece is looked up in it by binary
search; the range of suffixes that begin with it are its occurrences. These are the edges of a
graph over the places of the text. Sorted by the place they start at, the longest first, they are
relaxed from there: an edge is taken if its piece may follow the piece that the way to its start
ends with. Models that merge pairs have one way at most to every place, as pieces can only stand
side by side if merging the two would give these two again; that is worked out once a pair.

Encodings of parts are remembered within a task, up to a bound. Every batch stands for itself, so
a lost executor costs the batches it worked on.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.common import free_names

MARK = "▁"  # stands for a space
BATCH_CHARS = 1 << 20
LEARN_CHARS = 1 << 17  # of parts that are put into one suffix array
MOST_REMEMBERED = 1 << 18
MOST_PAIRS = 1 << 18
KEY_CHARS = 4
UNKNOWN_CODE = 0xFFFE
NONE = -1


class Vocabulary:
    """What is read of a model: its pieces and their order of merging."""

    def __init__(self, model: bytes):
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [reader.id_to_piece(i) for i in range(len(reader))]
        self.unknown = reader.unk_id()
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if reader.is_byte(i)}
        plain = [i for i in range(len(reader)) if not (
            reader.is_byte(i) or reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        # Pairs merge by score, the highest first; of equal ones the first in the text.
        self.rank = {self.pieces[i]: -reader.get_score(i) for i in plain}
        self.normalize = reader.normalize
        self.decoded = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            self.decoded[i] = bytes([value])
        for i in range(len(reader)):
            if reader.is_control(i):
                self.decoded[i] = b""
        self.decoded[self.unknown] = " ⁇ ".encode()

    def merged(self, text: str, watch: list | None = None) -> list[str]:
        """The text merged pair by pair; `watch` gets the rank and both ends' symbols at each merge."""
        n = len(text)
        symbols, after, before = list(text), [*range(1, n), NONE], [NONE, *range(n - 1)]
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j != NONE and symbols[i] + symbols[j] in self.rank:
                both = symbols[i] + symbols[j]
                heapq.heappush(heap, (self.rank[both], i, both))

        for i in range(n - 1):
            offer(i)
        last = n - 1
        while heap:
            rank, i, both = heapq.heappop(heap)
            j = after[i] if symbols[i] else NONE
            if j == NONE or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, ""
            after[i] = after[j]
            if after[j] != NONE:
                before[after[j]] = i
            if j == last:
                last = i
            if watch is not None:
                watch.append((rank, symbols[0], symbols[last]))
            if before[i] != NONE:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s]


class Encoder:
    def __init__(self, model: bytes):
        self.words = Vocabulary(model)
        rank = self.words.rank
        # Pieces that merging cannot give are never used. Of the others, the merges inside, in order.
        self.runs: dict[str, list] = {}
        for piece in rank:
            watch: list = []
            if self.words.merged(piece, watch) == [piece]:
                self.runs[piece] = watch
        inner = {a + b for p in self.runs for a, b in zip(p, p[1:])}
        self.whole_only = any(pair[1] == MARK and pair[0] != MARK for pair in inner)
        letters = "".join(re.escape(c) for c in sorted({c for pair in inner for c in pair} - {MARK}))
        self.parts = re.compile(f"{MARK}*[{letters}]+|{MARK}+|[^{letters}{MARK}]") if letters else re.compile(f"{MARK}+|[^{MARK}]")

        self.alphabet = {c: k + 1 for k, c in enumerate(sorted({c for p in self.runs for c in p}))}
        if len(self.alphabet) >= UNKNOWN_CODE:
            raise ValueError("the model has more characters than a search key can hold")
        self.code_of = np.full(0x110000, UNKNOWN_CODE, np.uint16)
        for c, k in self.alphabet.items():
            self.code_of[ord(c)] = k
        # Edges are of the pieces without runs of marks, whose merges tie; parts with such runs are merged directly.
        usable = [p for p in self.runs if MARK * 2 not in p]
        self.edge_pieces = usable
        self.edge_ids = np.array([*(self.words.ids[p] for p in usable), NONE], np.int64)
        self.edge_len = np.array([*map(len, usable), 1], np.int64)  # the last: a character that is no piece
        self.depth = -(-max(map(len, usable), default=1) // KEY_CHARS)
        codes = np.zeros((len(usable), self.depth * KEY_CHARS), np.uint64)
        for k, p in enumerate(usable):
            codes[k, :len(p)] = [self.alphabet[c] for c in p]
        shifts = np.array([48, 32, 16, 0], np.uint64)
        blocks = codes.reshape(len(usable), self.depth, KEY_CHARS)
        self.low = (blocks << shifts).sum(2, dtype=np.uint64)
        self.high = (np.where(blocks == 0, np.uint64(0xFFFF), blocks) << shifts).sum(2, dtype=np.uint64)
        self.pairs: dict[int, bool] = {}
        self.remembered: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.remembered.clear()
        self.ends = array("q", [0])
        self.flat = array("i")

    def may_follow(self, a: str, b: str) -> bool:
        """Whether merging a + b gives a and b again: no merge across their seam comes before those
        within them. At each step the lowest rank goes first, and of equal ones the leftmost."""
        rank = self.words.rank
        left, right = self.runs.get(a, ()), self.runs.get(b, ())
        i = j = 0
        end, start = a[-1], b[0]
        while True:
            seam = rank.get(end + start)
            x = left[i][0] if i < len(left) else None
            y = right[j][0] if j < len(right) else None
            if seam is not None and (x is None or seam < x) and (y is None or seam <= y):
                return False
            if x is None and y is None:
                return True
            if y is None or (x is not None and x <= y):
                end = left[i][2]
                i += 1
            else:
                start = right[j][1]
                j += 1

    def occurrences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, piece) of every occurrence of every piece, from a suffix array of the codes."""
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(self.depth * KEY_CHARS, np.uint16)]).astype(np.uint64)
        key = (padded[:-3] << np.uint64(48)) | (padded[1:-2] << np.uint64(32)) | (padded[2:-1] << np.uint64(16)) | padded[3:]
        keys = [key[KEY_CHARS * d:KEY_CHARS * d + n] for d in range(self.depth)]
        # Sorted by as many characters as the longest piece has, twice as many a round.
        suffixes, reach, key = np.argsort(keys[0]), KEY_CHARS, keys[0]
        while reach < self.depth * KEY_CHARS:
            ordered = key[suffixes]
            rank = np.empty(n, np.int64)
            rank[suffixes] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            key = rank * (n + 1)
            if reach < n:
                key[:n - reach] += rank[reach:] + 1
            suffixes, reach = np.argsort(key), reach * 2
        first = keys[0][suffixes]
        low = np.searchsorted(first, self.low[:, 0], "left")
        high = np.searchsorted(first, self.high[:, 0], "right")
        for d in range(1, self.depth):
            longer = np.flatnonzero((self.edge_len[:-1] > d * KEY_CHARS) & (low < high))
            if not len(longer):
                break
            low[longer], high[longer] = (
                self.bound(keys[d], suffixes, low[longer], high[longer], self.low[longer, d], False),
                self.bound(keys[d], suffixes, low[longer], high[longer], self.high[longer, d], True))
        count = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        return suffixes[np.repeat(low, count) + within], piece

    @staticmethod
    def bound(key: np.ndarray, suffixes: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
        """Binary search in many ranges at once: the first suffix whose key is not below (or above) the wanted."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            found = key[suffixes[middle]]
            right = found <= wanted[open_] if after else found < wanted[open_]
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]

    def spelled(self, text: str) -> list[int]:
        """A character that is no piece, as its bytes; without byte pieces, as the unknown piece."""
        if len(self.words.bytes) < 256:
            return [self.words.unknown]
        return [self.words.bytes[b] for b in text.encode()]

    def ids_of(self, pieces: Iterable[str]) -> list[int]:
        ids, out = self.words.ids, []
        for p in pieces:
            if p in ids:
                out.append(ids[p])
            else:
                out.extend(self.spelled(p))
        return out

    def learn(self, parts: list[str]) -> None:
        """Puts the ids of the parts behind those known, by one suffix array of all parts."""
        direct = [MARK * 2 in p for p in parts]
        joined = "\0".join("" if d else p for p, d in zip(parts, direct)) + "\0"
        codes = self.code_of[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        lengths = np.array([0 if d else len(p) for p, d in zip(parts, direct)], np.int64)
        begins = np.cumsum(lengths + 1) - lengths - 1
        codes[begins + lengths] = 0
        place, piece = self.occurrences(codes)
        odd = np.flatnonzero(codes == UNKNOWN_CODE)  # an edge of its own for each character that is no piece
        none = len(self.edge_pieces)
        place, piece = np.concatenate([place, odd]), np.concatenate([piece, np.full(len(odd), none)])
        # By start, the longest first; equal places and sizes are one piece.
        order = np.argsort(place * 64 + (63 - np.minimum(self.edge_len[piece], 63)))
        place, piece = place[order], piece[order]
        first = np.searchsorted(place, np.arange(len(codes) + 1)).tolist()
        ends, ids, piece = (place + self.edge_len[piece]).tolist(), self.edge_ids[piece].tolist(), piece.tolist()

        # A place is reached in one way at most, so one that no edge leads on from is dead for good.
        names, pairs, flat, known_ends = self.edge_pieces, self.pairs, self.flat, self.ends
        known, dead = pairs.get, bytearray(len(codes) + 1)
        for part, is_direct, begin, length in zip(parts, direct, begins.tolist(), lengths.tolist()):
            if is_direct:
                flat.extend(self.ids_of(self.words.merged(part)))
                known_ends.append(len(flat))
                continue
            stop, way, k, past, before = begin + length, [], first[begin], first[begin + 1], none
            at = begin
            while at < stop:
                while k < past:
                    p = piece[k]
                    if not dead[ends[k]]:
                        if before == none or p == none:
                            break
                        pair = before * none + p
                        fits = known(pair)
                        if fits is None:
                            if len(pairs) >= MOST_PAIRS:
                                pairs.clear()
                            fits = pairs[pair] = self.may_follow(names[before], names[p])
                        if fits:
                            break
                    k += 1
                if k < past:
                    way.append(k)
                    at, before = ends[k], p
                    k, past = first[at], first[at + 1]
                else:
                    dead[at] = 1
                    k = way.pop()
                    at, before = (ends[way[-1]], piece[way[-1]]) if way else (begin, none)
                    k, past = k + 1, first[at + 1]
            found = [ids[k] for k in way]
            if NONE in found:
                found = []
                for k in way:
                    found.extend([ids[k]] if ids[k] != NONE else self.spelled(joined[ends[k] - 1]))
            flat.extend(found)
            known_ends.append(len(flat))

    def cut(self, text: str) -> Iterator[list[str]]:
        """The parts of a normalised text, some at a time; no piece reaches from one part into the next."""
        if self.whole_only:
            yield [text]
            return
        at = 0
        while at < len(text):
            stop = at + BATCH_CHARS
            while stop < len(text) and not (text[stop] == MARK and text[stop - 1] != MARK):
                stop = text.find(MARK, stop + 1) if text.find(MARK, stop + 1) >= 0 else len(text)
            yield self.parts.findall(text, at, stop)
            at = stop

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text ends."""
        if len(self.remembered) > MOST_REMEMBERED:
            self.forget()
        known, spots, sizes, fresh = self.remembered, [], [], []
        for text in texts:
            n = 0
            for parts in self.cut(self.words.normalize(text)) if text else ():
                for p in parts:
                    if p not in known:
                        known[p] = len(known)
                        fresh.append(p)
                spots.append(np.fromiter(map(known.__getitem__, parts), np.int64, len(parts)))
                n += len(parts)
            sizes.append(n)
        start = size = 0
        for k, part in enumerate(fresh):
            if size and size + len(part) > LEARN_CHARS:
                self.learn(fresh[start:k])
                start, size = k, 0
            size += len(part)
        if fresh:
            self.learn(fresh[start:])
        ends, flat = np.array(self.ends, np.int64), np.array(self.flat, np.int32)
        spot = np.concatenate(spots) if spots else np.zeros(0, np.int64)
        begin, count = ends[spot], ends[spot + 1] - ends[spot]
        total = np.cumsum(count)
        ids = flat[np.repeat(begin - (total - count), count) + np.arange(total[-1] if len(total) else 0)]
        upto = np.concatenate([[0], total])[np.cumsum(np.array(sizes, np.int64))] if sizes else np.zeros(0, np.int64)
        return ids, upto

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: byte pieces are joined to characters, and the space put in front is taken off."""
        joined = b"".join(map(self.words.decoded.__getitem__, ids.tolist()))
        return joined.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def encoder(digest: bytes, model: bytes) -> Encoder:
    return Encoder(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def batches_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch in slices of about BATCH_CHARS characters, with the texts; a null text is empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = [len(t) if (t := x.as_py()) else 0 for x in texts] if len(texts) else []
    start = upto = 0
    for k, n in enumerate(sizes):
        if upto and upto + n > BATCH_CHARS:
            yield batch.slice(start, k - start), [t or "" for t in texts.slice(start, k - start).to_pylist()]
            start, upto = k, 0
        upto += n
    if len(sizes) > start:
        yield batch.slice(start), [t or "" for t in texts.slice(start).to_pylist()]


def encoded(df: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids", count_col: str = "n_tokens") -> DataFrame:
    """`df` with the ids of each text and their number.

    Null and empty texts have no ids. A text of any length is worked on whole. Characters that the
    model lacks become byte pieces. Columns of `df` that have a new column's name give theirs up.
    """
    kept = [c for c in df.columns if c.lower() not in (ids_col.lower(), count_col.lower())]
    hidden = free_names(df, "text_to_encode")[0]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).alias(hidden))
    schema = T.StructType([f for f in source.schema if f.name != hidden] + [
        T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False), T.StructField(count_col, T.LongType(), False)])
    digest = hashlib.sha256(model).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(digest, model)
        for batch in batches:
            for part, texts in batches_of(batch, hidden):
                ids, ends = work.encode(texts)
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                counts = pa.array(np.diff(ends, prepend=0), pa.int64())
                columns = [part.column(i) for i, f in enumerate(part.schema) if f.name != hidden]
                names = [f.name for f in part.schema if f.name != hidden]
                yield pa.RecordBatch.from_arrays([*columns, lists, counts], [*names, ids_col, count_col])

    return source.mapInArrow(run, schema)


def decoded(df: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`df` with the text of each list of ids; a null list gives an empty text. A column of `df`
    with the new column's name gives it up."""
    kept = [c for c in df.columns if c.lower() != text_col.lower()]
    hidden = free_names(df, "ids_to_decode")[0]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(ids_col).alias(hidden))
    schema = T.StructType([f for f in source.schema if f.name != hidden] + [T.StructField(text_col, T.StringType(), False)])
    digest = hashlib.sha256(model).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(digest, model)
        for batch in batches:
            at = batch.schema.get_field_index(hidden)
            texts = [work.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(at)]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for n in batch.schema.names if n != hidden]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, text_col])

    return source.mapInArrow(run, schema)


def encoding_report(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, number of ids, SHA-256 of the ids (little-endian 32-bit), and whether
    decoding them gives the text again. Only a text that holds the mark for a space itself does not.
    A null text counts as empty. Repeated rows each get their row; an empty table gives an empty report.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())])
    digest = hashlib.sha256(model).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(digest, model)
        for batch in batches:
            for part, texts in batches_of(batch, "text"):
                ids, ends = work.encode(texts)
                lists = np.split(ids, ends[:-1])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in lists], pa.string()),
                    pa.array([work.decode(x) == t for x, t in zip(lists, texts)], pa.bool_()),
                ], schema.fieldNames())

    return source.mapInArrow(run, schema)
