"""SimHash near-duplicates: every fingerprint against every other, in tiles.

Equal fingerprints are folded first. The distinct ones are ordered by their number of set bits
and cut into tiles of equal size from a histogram of 65 counts. Fingerprints within `radius` bits
of each other differ by at most `radius` in that number, so only tiles whose ranges come that
close are paired. A task takes one pair of tiles and skips in the same way on parts of the
fingerprints: it splits both sides by the set bits of halves, quarters and bytes, and leaves pairs
of groups whose differences add up to more than the radius. What remains is compared in full
with an exclusive or and a bit count. A task returns a spanning forest of the links it found, at
most one link a fingerprint, so a cluster of any size never becomes all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from veilframe.llm.common import free_names, sent_if_few, without_ids
from veilframe.llm.connected import components
from veilframe.session import written, written_and_counted

TILES = 16
LEAST_TILE = 2048
MOST_TILE = 1 << 18
BLOCK = 1 << 15
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of a text as a signed number; of a text without words, zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    starts, stops = first[:len(words) - k + 1].tolist(), (ends[k - 1:] - 1).tolist()
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(line[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[at:at + HASHES_AT_ONCE]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text_col: str, shingle: int):
    @pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.fromiter((fingerprint(t, shingle) for t in texts), np.int64, len(texts)))

    return of(F.col(text_col))


def follow(label: np.ndarray) -> None:
    while True:
        further = label[label]
        if np.array_equal(further, label):
            return
        label[:] = further


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a[i] and b[i]; label holds each item's smallest known companion."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(x[apart], y[apart]), np.minimum(x[apart], y[apart]))
        follow(label)


# The parts of a fingerprint that are counted, as ranges of bytes, and the place of the part each is cut from.
PARTS = ((0, 8, None), (0, 4, 0), (0, 2, 0), (4, 6, 1), (0, 1, 0), (4, 5, 1), (2, 3, 2), (6, 7, 3))


def part_counts(codes: np.ndarray) -> np.ndarray:
    """Set bits of each of PARTS, a column a part."""
    by_byte = np.bitwise_count(np.ascontiguousarray(codes).view(np.uint8).reshape(-1, 8))
    return np.stack([by_byte[:, a:b].sum(1, dtype=np.int64) for a, b, _ in PARTS], axis=1)


class Side:
    """Places of codes, ordered by their part counts, so that codes alike in the first parts are a slice."""

    def __init__(self, codes: np.ndarray, places: np.ndarray):
        counts = part_counts(codes[places])
        order = np.lexsort(counts.T[::-1])
        self.places, self.codes, self.counts = places[order], codes[places[order]], counts[order]
        self.known: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}

    def split(self, start: int, stop: int, depth: int) -> list[tuple[int, int, int]]:
        """The slice by the count of a part: (count, start, stop)."""
        at = (start, stop, depth)
        if at not in self.known:
            column = self.counts[start:stop, depth]
            cuts = [start, *(np.flatnonzero(column[1:] != column[:-1]) + start + 1).tolist(), stop]
            self.known[at] = [(int(self.counts[x, depth]), x, y) for x, y in zip(cuts, cuts[1:]) if y > x]
        return self.known[at]


def close_pairs(codes: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, label: np.ndarray) -> None:
    """Merges the labels of all pairs of places in left x right whose codes are within `radius` bits.

    Both sides are split by the set bits of one part after another. A part's difference and that of
    the rest of what it is cut from take the place of the latter's; groups whose differences add up
    to more than the radius hold no pair and are left. Small groups are compared bit by bit.
    """
    a, b = Side(codes, left), Side(codes, right)
    bits, ones, near = np.empty(BLOCK, np.uint64), np.empty(BLOCK, np.uint8), np.empty(BLOCK, bool)
    stack = [(0, len(left), 0, len(right), 0, ())]
    while stack:
        a0, a1, b0, b1, depth, apart = stack.pop()
        if (a1 - a0) * (b1 - b0) > BLOCK and depth < len(PARTS):
            parent = PARTS[depth][2]
            for u, u0, u1 in a.split(a0, a1, depth):
                for v, v0, v1 in b.split(b0, b1, depth):
                    d = u - v
                    now = (d,) if parent is None else (*apart[:parent], d, *apart[parent + 1:], apart[parent] - d)
                    if sum(map(abs, now)) <= radius:
                        stack.append((u0, u1, v0, v1, depth + 1, now))
            continue
        for c0 in range(b0, b1, BLOCK):
            there = b.codes[c0:min(b1, c0 + BLOCK)]
            step = max(1, BLOCK // len(there))
            for r0 in range(a0, a1, step):
                here = a.codes[r0:min(a1, r0 + step)]
                n = len(here) * len(there)
                np.bitwise_xor(here[:, None], there[None, :], out=bits[:n].reshape(len(here), len(there)))
                np.bitwise_count(bits[:n], out=ones[:n])
                if np.less_equal(ones[:n], radius, out=near[:n]).any():
                    i, j = np.divmod(np.flatnonzero(near[:n]), len(there))
                    merge(label, a.places[r0 + i], b.places[c0 + j])


def links_between_tiles(radius: int):
    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        signed = pdf["code"].to_numpy(np.int64)
        codes = signed.view(np.uint64)
        second = pdf["second"].to_numpy(bool)
        label = np.arange(len(codes))
        here, there = np.flatnonzero(~second), np.flatnonzero(second)
        own = pdf["tile_a"].iloc[0] == pdf["tile_b"].iloc[0]
        close_pairs(codes, here, here if own else there, radius, label)
        linked = np.flatnonzero(label != np.arange(len(codes)))
        return pd.DataFrame({"a": signed[linked], "b": signed[label[linked]]})

    return of


def near_links(codes: DataFrame, radius: int, tile_rows: int | None = None) -> DataFrame:
    """a, b: links that hold together all fingerprints (distinct, column `code`) within `radius` bits."""
    ones = F.bit_count("code").cast("int")
    histogram = {r["ones"]: r["n"] for r in codes.groupBy(ones.alias("ones")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(histogram.values())
    tiles = max(1, min(TILES, math.ceil(total / LEAST_TILE)), math.ceil(total / MOST_TILE))
    if tile_rows:
        tiles = max(1, math.ceil(total / tile_rows))
    # Rank by (set bits, a hash of the code): `below` rows have fewer set bits.
    below, low, high, upto = {}, [None] * tiles, [None] * tiles, 0
    for k in range(65):
        below[k] = upto
        n = histogram.get(k, 0)
        if n:
            for t in range(upto * tiles // total, (upto + n - 1) * tiles // total + 1):
                low[t], high[t] = (k if low[t] is None else low[t]), k
        upto += n
    # A tile is paired with those at or after it that begin within the radius of its end.
    last, first = [], []
    for t in range(tiles):
        near = [u for u in range(tiles) if high[t] is not None and low[u] is not None
                and low[u] - high[t] <= radius and low[t] - high[u] <= radius]
        first.append(min(near, default=t))
        last.append(max(near, default=t))

    def listed(values) -> F.Column:
        return F.array(*[F.lit(int(v)) for v in values])

    rank = F.get(listed(below[k] for k in range(65)).cast("array<long>"), ones) + F.pmod(
        F.xxhash64(F.col("code"), F.lit("tile")), F.get(listed(max(1, histogram.get(k, 0)) for k in range(65)).cast("array<long>"), ones))
    placed = codes.select("code", rank.alias("rank")).selectExpr(
        "code", f"cast((rank * {tiles}L) div {max(1, total)}L as int) AS tile")
    other = F.explode(F.sequence(F.get(listed(first), F.col("tile")), F.get(listed(last), F.col("tile")))).alias("other")
    dealt = placed.select("code", "tile", other).select(
        "code", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"),
        (F.col("tile") > F.col("other")).alias("second"))
    return dealt.groupBy("tile_a", "tile_b").applyInPandas(links_between_tiles(radius), "a long, b long")


def near_groups(df: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """The table (id, code) of all rows, written, and (code, component_id) of codes that have a link to
    another code or more than one row: the smallest id of the group."""
    rows = written(df.select(F.col(id_col).alias("id"), fingerprints(text_col, shingle).alias("code")), "simhash")
    codes = written(rows.groupBy("code").agg(F.min("id").alias("least")), "simhash_codes")
    roots = components(near_links(codes.select("code"), radius))
    joined = codes.join(roots.select(F.col("node").alias("code"), "root"), "code", "left").withColumn(
        "root", F.coalesce("root", "code"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, joined.join(least, "root").select("code", "component_id")


def near_duplicate_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                          radius: int = 4) -> DataFrame:
    """One row for each row given: id, fingerprint (16 hex digits) and component_id, the smallest id
    among the rows its fingerprint reaches by steps of at most `radius` bits.

    Null, empty and white texts have the fingerprint zero and are linked like others. A null id is
    never the smallest; a group without ids has none. Repeated rows each get their row. An empty
    table gives an empty report.
    """
    rows, groups = near_groups(df, id_col, text_col, shingle, radius)
    return rows.join(groups, "code", "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of the document with the smallest id of each group, with their columns as they were.

    A row goes by its own fingerprint: rows that share an id but not a group are judged each in its
    group. Rows without an id stay. Rows that share the id that stays, in its group, are one document,
    and stay.
    """
    rows, groups = near_groups(df, id_col, text_col, shingle, radius)
    judged = rows.where("id IS NOT NULL").join(groups, "code", "left")
    stays = F.col("component_id").isNull() | (F.col("id") == F.col("component_id"))
    gone, count = written_and_counted(judged.where(~stays).select("id", "code").distinct(), "simhash_gone")
    # Ids of rows that go which other rows, that stay, have as well: only there the fingerprint decides.
    ids = sent_if_few(gone.select("id").distinct(), count, 64)
    split, shared = written_and_counted(judged.where(stays).join(ids, "id", "left_semi").select("id").distinct(), "simhash_shared")
    if not shared:
        return without_ids(df, id_col, gone.select("id"), "simhash_gone_ids")
    key, code, gone_id, gone_code = free_names(df, "shared_id", "code", "gone_id", "gone_code")
    split = sent_if_few(split.toDF(key), shared, 64)
    whole = without_ids(df, id_col, gone.join(split, F.col("id") == F.col(key), "left_anti").select("id"), "simhash_gone_ids")
    doubtful = whole.join(split, F.col(key) == F.col(id_col), "left_semi").withColumn(code, fingerprints(text_col, shingle))
    pairs = sent_if_few(gone.toDF(gone_id, gone_code), count, 64)
    left = doubtful.join(pairs, (F.col(gone_id) == F.col(id_col)) & (F.col(gone_code) == F.col(code)), "left_anti").drop(code)
    return whole.join(split, F.col(key) == F.col(id_col), "left_anti").unionByName(left)
