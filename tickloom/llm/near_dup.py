"""SimHash near-duplicates: fingerprints that differ in at most MAX_BITS bits are linked, groups are the components.

Candidates come from Golay-code keys. A fingerprint is cut into segments of 23, 23 and 18 bits. Of at most 4 wrong
bits, the two best segments hold 0 and at most 2, or 1 and 1 (pigeonhole). So each fingerprint gets

* for every ordered pair (i, j): the bits of segment i with each codeword within 4 bits of segment j (covers 0 and 2);
* for every pair (i, j): each pair of codewords that ``golay.one_apart`` names (covers 1 and 1),

about 62 keys of 24 to 35 bits. Fingerprints with a key in common meet in one bucket and are verified there on all
64 bits, so no link is missed and none is false. A bucket passes on a spanning forest of its links, never all pairs.

Identical fingerprints are one node from the start: copies cost nothing, however many. Components are found by
alternating large-star and small-star steps on tables in the shared folder.

Defined results: a null text counts as empty, texts without words have fingerprint 0 and form a group with whatever
lies within 4 bits of it. Null doc_ids are kept in the result; component_id is the smallest doc_id that is there, null
if a component has none. Repeated rows are separate rows of one group. An empty table gives no rows. Ids are integers;
other types are cast, and text that is no number is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..ship import ship
from . import golay
from .arrow import map_texts, text_rows
from .store import without, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Rows of a bucket that are compared with one another by shifting; larger buckets are searched from node to node.
SHIFTED = 16
#: Buckets above this are cut once more, by five blocks of bits of which four errors leave one right.
LARGE = 20_000
#: (lowest bit, bits) of the segments.
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The majority of the bits of the XXH64 of each word shingle of a text, A-Z lowered."""
    words = text.encode().lower().split()  # bytes: just ASCII letters and blanks
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, fp, text_hash`` of every whole text: its fingerprint and the XXH64 of all of it, as signed longs."""

    def make():
        def longs(numbers: list[int]) -> np.ndarray:
            return np.array(numbers, np.uint64).view(np.int64)

        return lambda _, texts: [longs([fingerprint(t, shingle) for t in texts]), longs([xxhash.xxh64_intdigest(t.encode(), SEED) for t in texts])]

    return map_texts(text_rows(docs, id_col, text_col), "id long, fp long, text_hash long", make)


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, row of each key) of an array of fingerprints."""
    fp = fp.view(np.uint64)
    parts = [(fp >> np.uint64(low) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]
    two, one = [golay.within_four(p) for p in parts], [golay.one_apart(p) for p in parts]
    keys, rows, tag = [], [], 0
    for i in range(3):
        for j in range(3):
            if i != j:
                at, col = np.nonzero(two[j] >= 0)
                keys.append(tag << 40 | parts[i][at] << 12 | two[j][at, col])
                rows.append(at)
                tag += 1
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = np.where((one[i][:, :, None] >= 0) & (one[j][:, None, :] >= 0), one[i][:, :, None] << 12 | one[j][:, None, :], -1).reshape(len(fp), -1)
        at, col = np.nonzero(both >= 0)
        keys.append(tag << 40 | both[at, col])
        rows.append(at)
        tag += 1
    return np.concatenate(keys), np.concatenate(rows)


def forest(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of the distinct fingerprints of a bucket, found from node to node."""
    if len(fp) > LARGE:
        out = []
        for low in range(0, 64, 13):
            block = fp >> np.uint64(low) & np.uint64(8191)
            order = np.argsort(block, kind="stable")
            for part in np.split(fp[order], np.flatnonzero(np.diff(block[order])) + 1):
                if 1 < len(part) < len(fp):
                    out += forest(part)
                elif len(part) > 1:
                    out += walk(part)
        return out
    return walk(fp)


def walk(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out, rest = [], fp
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            u = todo.pop()
            near = np.bitwise_count(rest ^ u) <= MAX_BITS
            if near.any():
                found, rest = rest[near], rest[~near]
                out.append((np.full(len(found), u), found))
                todo += list(found)
    return out


def links_of_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key -> verified links (a, b), a < b as signed longs."""

    def links(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole buckets."""
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(first, len(key)))
        left, right = [], []
        size = np.repeat(sizes, sizes)
        some = (size > 1) & (size <= SHIFTED)
        k, f = key[some], fp[some]
        for d in range(1, SHIFTED):
            if d >= len(k):
                break
            same = k[d:] == k[:-d]
            if not same.any():
                break
            near = same & (np.bitwise_count(f[d:] ^ f[:-d]) <= MAX_BITS)
            left.append(f[:-d][near])
            right.append(f[d:][near])
        for at in np.flatnonzero(sizes > SHIFTED).tolist():
            for a, b in forest(fp[first[at] : first[at] + sizes[at]]):
                left.append(a)
                right.append(b)
        if left:
            a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    keys, fps, held = [], [], 0
    for batch in batches:
        key = batch.column("key").to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        keys.append(key)
        fps.append(fp)
        held += len(key)
        # What may go on in the next batch stays: the rows of the last key.
        if held >= 200_000 and key[-1] != keys[0][0]:
            k, f = np.concatenate(keys), np.concatenate(fps)
            cut = int(np.searchsorted(k, k[-1]))
            yield from links(k[:cut], f[:cut])
            keys, fps, held = [k[cut:]], [f[cut:]], len(k) - cut
    if keys:
        yield from links(np.concatenate(keys), np.concatenate(fps))


def candidate_links(distinct: DataFrame) -> DataFrame:
    """Verified links between distinct fingerprints (column ``fp``)."""
    ship(distinct.sparkSession)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 4096):
                own = fp[at : at + 4096]
                key, row = golay_keys(own)
                yield pa.RecordBatch.from_pydict({"key": pa.array(key), "fp": pa.array(own[row])})

    keys = distinct.select("fp").mapInArrow(keyed, "key long, fp long")
    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(links_of_buckets, "a long, b long").distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``node, root`` for every node of the links: root is the smallest node of its component.

    Large-star: each node hands its larger neighbours to its smallest one; small-star: its smaller ones. Both join on
    a node, so a hub's links may be split over tasks; nothing is gathered by node but minima.
    """
    links = written(links, name)
    state = None
    while True:
        sides = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Here v < u throughout.
        large = written(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", "m").union(small.where("v <> m").select(F.col("v").alias("u"), "m")).select(F.col("m").alias("a"), F.col("u").alias("b")).distinct()
        links = written(small, name)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, text_hash, component_id`` of every row; ``text_hash`` is Spark's ``xxhash64`` of the text."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least_id"))
    roots = components(candidate_links(nodes)).select(F.col("node").alias("fp"), "root")
    nodes = nodes.join(roots, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = nodes.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(F.col("id").alias("doc_id"), "fp", "text_hash", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (16 hexadecimal digits)``, component_id`` of every row."""
    return groups(docs, id_col, text_col, shingle).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, one of each group: of its smallest doc_id the text with the smallest hash. Rows without doc_id stay.

    A document is its doc_id and its text: of different texts under one doc_id each is judged by its own group, and of
    rows that repeat both one stays, that of the smallest hash over all its columns.
    """
    known = groups(docs, id_col, text_col).where("doc_id is not null")
    known = written(known.groupBy("doc_id", "text_hash", "component_id").agg(F.count("*").alias("n")), "groups")
    # The first text of a component is found among the rows of its smallest id alone.
    first = known.where("doc_id = component_id").groupBy("component_id").agg(F.min("text_hash").alias("first_hash"))
    verdicts = known.join(first, "component_id").select("doc_id", "text_hash", "n", ((F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))).alias("stays"))
    verdicts = written(verdicts.where("not stays or n > 1"), "verdicts")
    keys = {"doc_id": F.col(f"`{id_col}`").cast("long"), "text_hash": F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))}
    kept = without(docs, verdicts, keys)
    twice = verdicts.where("stays")
    if twice.isEmpty():
        return kept
    # Rows that stay but are there more than once.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = docs.select(row.alias("row"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("order"), *[e.alias(k) for k, e in keys.items()])
    again = again.join(twice.select(*keys), list(keys), "left_semi").groupBy(*keys).agg(F.min_by("row", "order").alias("row"))
    return kept.unionByName(again.select("row.*"))
