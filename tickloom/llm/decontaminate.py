"""Benchmark decontamination by template windows.

1. Texts become sequences of canonical tokens: numbers (digits or number words), units and names (capitalised inside a
   sentence) turn into typed placeholders, all other words into lower case without marks.
2. Windows of WINDOW tokens of the benchmark items are a table ``hash, n, item, q``. A filter of fixed size made of
   their hashes goes to the documents' scan, so that only windows which may be known leave it, and only texts that have
   one. These are joined with the table by hash.
3. Where a window hits, the whole item is laid beside the document, and its tokens that agree are covered; what it lacks
   there may come from hits up to SHIFT tokens further on. Then slots are checked: a placeholder of the item must stand
   for the same value of the document each time, and different values for different ones; slots that don't agree
   aren't covered. Each place is judged alone, and the best one counts.

An item is leaked into a document if CONTAINMENT of its tokens are covered, or RUN tokens in a row. So a question with
other numbers or names is found, while texts that merely have the same form, or hold an item's words far apart, are not.

Texts are known by their md5, so copies are judged once. Neither the benchmark nor the documents' hits are held whole
anywhere: verdicts stream over rows sorted by text, one text and one item at a time.

Defined results: null texts count as empty; documents and items without words are never matched; items below WINDOW
words match as one window of their length; items with the same text are all reported; every input row gets its row,
whatever its id, and repeated documents are judged alike; null item_ids are reported as null at the end; an empty
benchmark leaves all documents clean.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..ship import ship
from .arrow import slices
from .store import BROADCAST_ROWS, without, written

WINDOW = 5
CONTAINMENT = 0.8
RUN = 13
#: Words put in or left out in one copy, at most half of the item.
SHIFT = 16
#: Windows with fewer literal words aren't looked up, unless an item has no others.
LITERALS = 2
#: The filter that documents' windows pass before the join: so many words of 64 bits, whatever the benchmark's size.
FILTER_WORDS = 1 << 20
#: Where in a hash the bits are that place it in the filter.
FILTER_SHIFTS = (0, 19, 38)

# Words that stand for numbers and units.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
UNITS = "mm cm m km inch inches ft feet foot yard yards mile miles meter meters metre metres kilometer kilometers g kg mg gram grams kilogram kilograms pound pounds lb lbs ounce ounces ton tons l ml liter liters litre litres gallon gallons s sec second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros usd eur percent degree degrees celsius fahrenheit kelvin joule joules watt watts volt volts amp amps hz khz mhz ghz byte bytes kb mb gb tb"

KINDS = {w: "<number>" for w in NUMBERS.split()} | {w: "<unit>" for w in UNITS.split()}
WORD = re.compile(r"[$€£](?=[0-9])|[^\W_]+(?:[.,:/][0-9]+)*|(?<=[0-9])[%$€£°]")
NAME = "<name>"
SIGNS = {"%": "<unit>", "$": "<unit>", "€": "<unit>", "£": "<unit>", "°": "<unit>"}
#: What stands around plain words.
MARKS = ".,!?#$%&*|:;()[]\"'-"
#: Distinct runs between blanks that one worker remembers.
KEPT = 300_000


def tokens_of(run: str) -> list[tuple[str, str, bool]]:
    """(canonical, literal, may be a name) of the words in a run between blanks."""
    word = run.strip(MARKS)
    out = []
    for w in (word,) if word.isalpha() else WORD.findall(run):
        low = w.lower()
        if w in SIGNS:
            out.append((SIGNS[w], w, False))
        elif w[0].isdigit():
            out.append(("<number>", low, False))
        elif low in KINDS:
            out.append((KINDS[low], low, False))
        else:
            out.append((low, low, len(w) > 1 and w[0].isupper() and w[1:].islower()))
    return out


def ends_sentence(run: str) -> bool:
    return run.rstrip("\"')]»”*#$%&")[-1:] in (".", "!", "?", ":", "\n", "")


def canonical(text: str) -> list[tuple[str, str]]:
    """(canonical, literal) tokens of a text."""
    out, start = [], True
    for run in text.replace("\n", " \n ").split(" "):
        if run:
            for c, lit, name in tokens_of(run):
                out.append((NAME if name and not start else c, lit))
                start = False
            start = ends_sentence(run) if run != "\n" else True
    return out


_hash = xxhash.xxh64_intdigest
_NAME_HASH = _hash(NAME)
#: Odd multiplier of the rolling hash (fixed value, 2**64 over the golden ratio).
STEP = np.uint64(0x9E3779B97F4A7C15)

Tokens = list[tuple[str, str]]


def hashes_of(tokens: Tokens) -> np.ndarray:
    return np.array([_hash(c) for c, _ in tokens], np.uint64)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` tokens."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * STEP + h[k : len(h) - n + 1 + k]
        return (out ^ (out >> np.uint64(31))) * STEP


def item_windows(text: str) -> tuple[int, list[tuple[int, int]]]:
    """Length of an item's windows, and (hash, first token) of those that are looked up."""
    tokens = canonical(text)
    n = min(WINDOW, len(tokens))
    if not n:
        return 0, []
    literal = np.array([c[0] != "<" for c, _ in tokens], np.int64)
    enough = np.convolve(literal, np.ones(n, np.int64), "valid") >= min(n, LITERALS)
    found = windows(hashes_of(tokens), n).tolist()
    return n, [(h, q) for q, h in enumerate(found) if enough[q] or not enough.any()]


class Judge:
    """Verdicts on items in one text."""

    def __init__(self, text: str):
        self.tokens = canonical(text)
        self.hashes = hashes_of(self.tokens)

    def alignments(self, own: np.ndarray, places: list[tuple[int, int, int]]) -> Iterator[dict[int, int]]:
        """Tokens of an item -> tokens of the text, for hits (token of the item, token of the text, length): the whole item beside the text where a hit is, then with hits a little further on."""
        h = self.hashes
        shifts = defaultdict(list)
        for q, p, n in places:
            shifts[p - q].append((q, n))
        for s in sorted(shifts):
            low, high = max(0, -s), min(len(own), len(h) - s)
            found = {q: q + s for q in (np.flatnonzero(own[low:high] == h[low + s : high + s]) + low).tolist()}
            yield found
            near = [s + k for k in range(1, min(SHIFT, len(own) // 2) + 1) if s + k in shifts]
            if near and len(found) < len(own):  # words put in or left out
                found = dict(found)
                for t in near:
                    for q, n in shifts[t]:
                        stop = q + n
                        while q > 0 and q + t > 0 and own[q - 1] == h[q + t - 1]:
                            q -= 1
                        while stop < len(own) and stop + t < len(h) and own[stop] == h[stop + t]:
                            stop += 1
                        for k in range(q, stop):
                            found.setdefault(k, k + t)
                yield found

    def verdict(self, item: Tokens, found: dict[int, int]) -> tuple[float, int] | None:
        """(share of the item's tokens that are covered, slots with another value), if leaked."""
        if len(found) < min(CONTAINMENT * len(item), RUN):
            return None
        there: dict[str, str] = {}
        back: dict[str, str] = {}
        wrong, changed = set(), 0
        for q in sorted(found):
            c, lit = item[q]
            if c[0] != "<":
                continue
            other = self.tokens[found[q]][1]
            if there.setdefault(c + lit, other) != other or back.setdefault(c + other, lit) != lit:
                wrong.add(q)
            elif other != lit:
                changed += 1
        if wrong:  # not the same question with other values: values that differ count against it
            wrong |= {q for q in found if item[q][0][0] == "<" and self.tokens[found[q]][1] != item[q][1]}
        covered = sorted(set(found) - wrong)
        run = best = 0
        last = None
        for q in covered:
            run = run + 1 if last is not None and q == last + 1 else 1
            best, last = max(best, run), q
        share = len(covered) / len(item)
        return (share, changed) if share >= CONTAINMENT or best >= RUN else None

    def best(self, item: Tokens, places: list[tuple[int, int, int]]) -> tuple[float, int] | None:
        """The best verdict over all places of an item, if it has leaked."""
        best = None
        for found in self.alignments(hashes_of(item), places):
            v = self.verdict(item, found)
            if v and (best is None or (v[0], -v[1]) > (best[0], -best[1])):
                best = v
            if best == (1.0, 0):
                break
        return best


def compare(item: str, text: str) -> tuple[float, int] | None:
    """What the operator says of one item and one text, without tables."""
    n, own = item_windows(item)
    judge = Judge(text)
    there = defaultdict(list)
    for p, h in enumerate(windows(judge.hashes, n).tolist() if n else []):
        there[h].append(p)
    places = [(q, p, n) for h, q in own for p in there.get(h, ())]
    return judge.best(canonical(item), places) if places else None


class Scanner(dict):
    """Windows of texts that may be known. As a mapping: runs between blanks -> their number in the tables of tokens."""

    def __init__(self, bits: np.ndarray, lengths: list[int]):
        super().__init__()
        self.bits, self.lengths = bits, lengths
        self.start()

    def start(self) -> None:
        self.clear()
        self.update({"": 0, "\n": 1})
        self.hashes = array("Q")
        self.first = array("q", [0, 0])
        self.sizes = array("q", [0, 0])
        self.flags = bytearray([4, 2])  # 1: the first word may be a name; 2: a sentence ends; 4: no run at all

    def __missing__(self, run: str) -> int:
        k = self[run] = len(self.flags)
        tokens = tokens_of(run)
        self.first.append(len(self.hashes))
        self.sizes.append(len(tokens))
        self.flags.append(bool(tokens and tokens[0][2]) | 2 * ends_sentence(run))
        for j, (c, _, name) in enumerate(tokens):
            self.hashes.append(_NAME_HASH if name and j else _hash(c))
        return k

    def known(self, w: np.ndarray) -> np.ndarray:
        """Places of windows that are in the filter."""
        at = np.arange(len(w))
        for shift in FILTER_SHIFTS:
            place = w[at] >> np.uint64(shift) & np.uint64(FILTER_WORDS * 64 - 1)
            at = at[self.bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1]
        return at

    def hits(self, texts: list[str]) -> dict[int, list[tuple[int, int, int]]]:
        """text -> (hash, length, token) of its windows that may be known."""
        if len(self) > KEPT:
            self.start()
        split: list[str] = []
        ends = []
        for t in texts:
            split += t.replace("\n", " \n ").split(" ")
            ends.append(len(split))
        runs = np.fromiter(map(self.__getitem__, split), np.int64, len(split))
        flags = np.array(self.flags, np.uint8)[runs]
        there = np.flatnonzero(flags != 4)
        runs, flags = runs[there], flags[there]
        bounds = np.searchsorted(there, np.array(ends, np.int64))  # of the texts, in runs
        before = np.concatenate([np.full(1, 2, np.uint8), flags[:-1]])[: len(runs)]
        before[bounds[bounds < len(runs)]] = 2
        sizes = np.array(self.sizes, np.int64)[runs]
        stops = np.cumsum(sizes)
        starts = stops - sizes
        tokens = np.array(self.hashes or [0], np.uint64)[np.repeat(np.array(self.first, np.int64)[runs] - starts, sizes) + np.arange(sizes.sum())]
        tokens[starts[(flags & 1 > 0) & (before & 2 == 0)]] = np.uint64(_NAME_HASH)
        edges = np.concatenate([[0], np.concatenate([[0], stops])[bounds]])  # of the texts, in tokens
        out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for n in self.lengths:
            w = windows(tokens, n)
            at = self.known(w)
            text = np.searchsorted(edges, at, side="right") - 1
            whole = at + n <= edges[text + 1]
            for d, p, h in zip(text[whole].tolist(), at[whole].tolist(), w[at[whole]].view(np.int64).tolist(), strict=True):
                out[d].append((h, n, p - int(edges[d])))
        return out


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


HITS = "array<struct<hash:long,n:int,p:int>>"
PLACES = "array<struct<q:int,p:int,n:int>>"


def window_table(items: DataFrame) -> DataFrame:
    """``hash, n, item, q`` of distinct items (item, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                n, own = item_windows(text)
                rows += [(h - (1 << 64) if h >> 63 else h, n, item, q) for h, q in own]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.int32()), strict=True)], names=["hash", "n", "item", "q"])

    return items.mapInArrow(run, "hash long, n int, item binary, q int")


def filter_bits(table: DataFrame) -> np.ndarray:
    """The filter: at most FILTER_WORDS rows come to the driver."""
    places = F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(F.lit(FILTER_WORDS * 64 - 1)) for s in FILTER_SHIFTS])
    words = table.select(F.explode(places).alias("place")).select(F.shiftright("place", 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int")).alias("m"))
    found = words.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    bits = np.zeros(FILTER_WORDS, np.uint64)
    bits[found.column("w").to_numpy()] = found.column("m").to_numpy().view(np.uint64)
    return bits


def candidates(docs: DataFrame, text_col: str, table: DataFrame) -> DataFrame:
    """``key, text, hits`` of the distinct texts with windows that may be known."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(filter_bits(table))
    lengths = sorted(r.n for r in table.select("n").distinct().collect())  # WINDOW at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = None
        hit = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int32()), ("p", pa.int32())]))
        for batch in batches:
            for part in slices(batch):
                scanner = scanner or Scanner(bits.value, lengths)
                found = scanner.hits(part.column("text").to_pylist())
                if found:
                    own = part.take(pa.array(sorted(found)))
                    rows = [[dict(zip(("hash", "n", "p"), h, strict=True)) for h in found[d]] for d in sorted(found)]
                    yield pa.RecordBatch.from_arrays([own.column("key"), own.column("text"), pa.array(rows, hit)], names=["key", "text", "hits"])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = docs.select(text_key(text).alias("key"), text.alias("text")).mapInArrow(run, f"key binary, text string, hits {HITS}")
    return written(found, "candidates").groupBy("key").agg(F.first("text").alias("text"), F.first("hits").alias("hits"))


def judged(rows: DataFrame) -> DataFrame:
    """``key, item, containment, slots_changed`` of leaked items. ``rows``: for each key its text, then its items with the places of their hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, judge = None, None
        for batch in batches:
            out = []
            for key, item, text, places in zip(*(batch.column(c).to_pylist() for c in ("key", "item", "text", "places")), strict=True):
                if key != now:
                    now, judge = key, None
                if item is None:
                    judge = Judge(text)
                    continue
                v = judge.best(canonical(text), sorted((x["q"], x["p"], x["n"]) for x in places))
                if v:
                    out.append((key, item, *v))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.float64(), pa.int64()), strict=True)], names=["key", "item", "containment", "slots_changed"])

    dealt = rows.repartition("key").sortWithinPartitions(F.col("key"), F.col("item").asc_nulls_first())
    return dealt.mapInArrow(run, "key binary, item binary, containment double, slots_changed long")


def leaks(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``key`` (md5 of a text)``, item_ids`` (ascending, nulls last)``, containment`` (the largest)``, slots_changed`` of the texts into which items have leaked."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(f"`{item_text_col}`"), F.lit(""))
    bench = bench.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), text_key(text).alias("item"), text.alias("text"))
    items = written(bench.groupBy("item").agg(F.first("text").alias("text")), "items")
    table = written(window_table(items), "item-windows")
    found = written(candidates(docs, text_col, table), "candidate-texts")
    hits = found.select("key", F.inline("hits")).join(table, ["hash", "n"]).groupBy("key", "item").agg(F.collect_list(F.struct("q", "p", "n")).alias("places"))
    pairs = written(hits.join(items, "item").select("key", "item", "text", "places"), "hits")
    texts = found.join(pairs.select("key").distinct(), "key", "left_semi").select("key", F.lit(None).cast("binary").alias("item"), "text", F.lit(None).cast(PLACES).alias("places"))
    each = judged(texts.unionByName(pairs)).join(bench.select("item", "item_id"), "item")
    ids = F.transform(F.array_sort(F.collect_list(F.struct(F.col("item_id").isNull().alias("none"), F.col("item_id").alias("id")))), lambda x: x["id"])
    return written(each.groupBy("key").agg(ids.alias("item_ids"), F.max("containment").alias("containment"), F.sum("slots_changed").alias("slots_changed")), "leaks")


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, contaminated, item_ids`` (ascending)``, containment`` (the largest)``, slots_changed`` of every row."""
    found = leaks(docs, bench, text_col, item_col, item_text_col)
    if (found.agg(F.sum(4 + F.size("item_ids"))).first()[0] or 0) <= BROADCAST_ROWS:
        found = F.broadcast(found)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_key(F.col(f"`{text_col}`")).alias("key"))
    none = F.array().cast("array<long>")
    verdict = (F.col("containment").isNotNull().alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("containment", F.lit(0.0)).alias("containment"), F.coalesce("slots_changed", F.lit(0)).cast("long").alias("slots_changed"))
    return rows.join(found, "key", "left").select("doc_id", *verdict)


def drop_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents into which no item has leaked."""
    return without(docs, leaks(docs, bench, text_col, item_col, item_text_col).select("key"), {"key": text_key(F.col(f"`{text_col}`"))})
