"""Packing token pieces into sequences: bin completion over the sizes, ranks for the documents."""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import few, written

CAPACITY = 1024
#: Steps that each of the two rounds of the search may take before it settles for the best so far.
EFFORT = 400_000
#: Fillings tried around the largest size of a state while only a better incumbent is looked for.
FILLINGS = 6
#: Tokens that a task holds before it passes them on.
BUFFER = 1 << 20

# How byte-level BPE cuts a text into words before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters on whose classes both tokenizer libraries agree; other texts take the slower one.
_COMMON = re.compile("[^\x00-ȳΑ-ΡЀ-џ‐-‧‰-›€←-⇿]")


def kept_by_worker(name: str, make: Callable):
    """``make()``, or what it gave before in this Python process; for what is dear to set up."""
    holder = sys.modules.setdefault("_pollpipe_worker", types.ModuleType("_pollpipe_worker"))
    if name not in vars(holder):
        setattr(holder, name, make())
    return getattr(holder, name)


def encoder(vocabulary: str) -> Callable[[str], np.ndarray]:
    """Text to ids for a byte-level BPE file (JSON) of the tokenizers library.

    The ids are that library's, without special tokens being added. Texts of common characters
    go through tiktoken with the same vocabulary, which is several times faster; a text that
    holds another character or an added token of the file goes through the library itself.
    """
    name = f"bpe_{zlib.crc32(vocabulary.encode()):08x}"
    fast, added = kept_by_worker(name, lambda: _fast_encoder(vocabulary))

    def exact(text: str) -> list[int]:
        import tokenizers

        whole = kept_by_worker(name + "_exact", lambda: tokenizers.Tokenizer.from_str(vocabulary))
        return whole.encode(text, add_special_tokens=False).ids

    def encode(text: str) -> np.ndarray:
        if (text.isascii() or not _COMMON.search(text)) and not any(a in text for a in added):
            return fast.encode_to_numpy(text, disallowed_special=())
        return np.array(exact(text), np.uint32)

    return encode


def _fast_encoder(vocabulary: str):
    import tiktoken

    parts = json.loads(vocabulary)
    added = [t["content"] for t in parts["added_tokens"]]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    of_char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(of_char[c] for c in token): i for token, i in parts["model"]["vocab"].items() if token not in added}
    return tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}), added


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole if it fits, else the first one short."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = ([0] if first else []) + list(range(first, length, capacity))
    return [(s, min(e, length) - s) for s, e in zip(starts, [*starts[1:], length], strict=True)]


def tokenize(
    docs: DataFrame, tokenizer: str, end: int = 2, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
    numbered: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``.

    ``ids`` are the token ids as little-endian unsigned 32-bit numbers. A document is its tokens and
    then ``end``; a NULL text counts as empty and is ``end`` alone. Every row gives its pieces, so
    repeated rows and NULL ids do too. The vocabulary travels to the tasks, the file need only be
    readable by the driver.

    With ``numbered`` there are ``task`` and ``own`` as well: how many pieces of its length its task has seen
    before it. Such pieces are to be written at once, as the numbers belong to that run of the tasks.
    """
    vocabulary = Path(tokenizer).read_text(encoding="utf-8")
    columns = ["doc_id", "piece", "start", "length", "ids", *(["task", "own"] if numbered else [])]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, rows, held = encoder(vocabulary), [], 0
        task, seen = TaskContext.get().partitionId() if numbered else None, defaultdict(int)
        for batch in batches:
            for i, content in zip(batch["id"], batch["text"], strict=True):
                ids = np.append(encode(content), np.uint32(end)).astype("<u4")
                for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                    rows.append((i, k, s, n, ids[s : s + n].tobytes(), *((task, seen[n]) if numbered else ())))
                    seen[n] += 1
                held += len(ids)
                if held >= BUFFER:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    schema = T.StructType([
        T.StructField("doc_id", T.StringType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        *([T.StructField("task", T.LongType()), T.StructField("own", T.LongType())] if numbered else []),
    ])
    kind = docs.schema[doc_id].dataType
    # Ids travel as text: pandas would turn long ids into floating-point numbers beside a NULL.
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(pieces, schema).withColumn("doc_id", F.col("doc_id").cast(kind))


Filling = tuple[int, ...]


def best_fit(counts: dict[int, int], capacity: int) -> dict[Filling, int]:
    """Best-fit decreasing over sizes with counts: each filling and how many bins have it."""
    open_: dict[int, dict[Filling, int]] = defaultdict(dict)  # by room left
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_ if r >= size and open_[r]), default=None)
            if room is None:
                group, bins, room = (), -(-left // (capacity // size)), capacity
            else:
                group, bins = open_[room].popitem()
            each = room // size
            full = min(bins, left // each)
            rest = left - full * each if full < bins else 0
            for take, number in ((each, full), (rest, 1)):
                if take and number:
                    spot, key = open_[room - take * size], group + (size,) * take
                    spot[key] = spot.get(key, 0) + number
                    left -= take * number
                    bins -= number
            if bins and group:
                open_[room][group] = open_[room].get(group, 0) + bins
    done: dict[Filling, int] = defaultdict(int)
    for groups in open_.values():
        for group, number in groups.items():
            done[group] += number
    return dict(done)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: total size, and what large sizes leave for the middle ones."""
    sizes = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        sizes[s] = n
    number, volume = np.cumsum(sizes), np.cumsum(sizes * np.arange(capacity + 1))
    best = -(-int(volume[-1]) // capacity)
    half = capacity // 2
    for k in range(1, half + 1):
        large = int(number[-1] - number[capacity - k])
        wide, wide_sum = int(number[capacity - k] - number[half]), int(volume[capacity - k] - volume[half])
        middle = int(volume[half] - volume[k - 1])
        best = max(best, large + wide + max(0, -(-(middle - (wide * capacity - wide_sum)) // capacity)))
    return best


class _Steps:
    def __init__(self, number: int):
        self.left = number

    def spend(self) -> bool:
        self.left -= 1
        return self.left >= 0


def first_fillings(counts: dict[int, int], order: list[int], room: int, steps: _Steps, most: int = FILLINGS) -> list[Filling]:
    """A few undominated ways to fill ``room`` with the sizes left, least waste first, for an incumbent.

    Largest sizes are tried first; the search ends at a filling without waste or after ``most``.
    A filling is dominated, and not returned, if one of its sizes could give way to a larger one
    that is left and fits, or two of them to a single one as large as both: the other filling
    then leaves smaller sizes over and can take no more bins.
    """
    found: list[Filling] = []
    seen: set[Filling] = set()
    used: dict[int, int] = defaultdict(int)

    def fits(limit: int) -> int | None:
        at = bisect_right(order, limit) - 1
        while at >= 0 and counts.get(order[at], 0) - used[order[at]] <= 0:
            at -= 1
        return order[at] if at >= 0 else None

    def dominated(items: Filling, waste: int) -> bool:
        for s in set(items):
            larger = fits(s + waste)
            if larger is not None and larger > s:
                return True
        for a, b in zip(items, items[1:], strict=False):
            whole = fits(a + b + waste)
            if whole is not None and whole >= a + b:
                return True
        return False

    def fill(items: Filling, left: int, ceiling: int) -> bool:
        size, tries = fits(min(left, ceiling)), 0
        if size is None:
            if items not in seen and (not found or left == 0 or not dominated(items, left)):
                seen.add(items)
                found.append(items)
            return left == 0 or len(found) >= most
        while size is not None and tries < most:
            if not steps.spend():
                return True
            used[size] += 1
            stop = fill((*items, size), left - size, size)
            used[size] -= 1
            if stop:
                return True
            tries += 1
            size = fits(size - 1)
        return False

    fill((), room, room)
    return sorted(found, key=lambda items: (room - sum(items), [-s for s in items]))


class _Sums:
    """Which sums the sizes left can make, as bits; what did not change since the last state is kept."""

    def __init__(self, capacity: int):
        self.capacity, self.most, self.bits = capacity, [], [1]

    def of(self, counts: dict[int, int], order: list[int]) -> list[int]:
        """For each place in ``order`` and after it, the sums of the sizes before that place."""
        most = [(s, min(counts[s], self.capacity // s)) for s in order]
        same = next((i for i, (a, b) in enumerate(zip(most, self.most, strict=False)) if a != b), min(len(most), len(self.most)))
        bits, within = self.bits[: same + 1], (1 << (self.capacity + 1)) - 1
        for s, n in most[same:]:
            made, part = bits[-1], 1
            while n:
                take = min(part, n)
                made |= made << (take * s) & within
                n, part = n - take, part * 2
            bits.append(made)
        self.most, self.bits = most, bits
        return bits


def fillings(
    counts: dict[int, int], order: list[int], size: int, capacity: int, bits: list[int],
    spare: Callable[[], int], barred: set[Filling], steps: _Steps,
) -> Iterator[Filling]:
    """All undominated fillings around one ``size``, the largest left, in order of their waste.

    They are looked for as they are asked for, waste by waste up to what is ``spare``, large sizes
    first; ``order`` has the sizes left, ``bits`` the sums that can be made without that one. Those in ``barred`` are left out.
    A filling is dominated if a size left fits beside it, if one of its sizes could give way to a larger
    one that is left and fits, or two of them to a single one as large as both: the other filling
    then leaves smaller sizes over and can take no more bins.
    """
    used: dict[int, int] = defaultdict(int, {size: 1})

    def fits(limit: int) -> int | None:
        at = bisect_right(order, limit) - 1
        while at >= 0 and counts[order[at]] - used[order[at]] <= 0:
            at -= 1
        return order[at] if at >= 0 else None

    def dominated(items: Filling, waste: int) -> bool:
        if fits(waste) is not None:
            return True
        for s in set(items):
            larger = fits(s + waste)
            if larger is not None and larger > s:
                return True
        for a, b in zip(items, items[1:], strict=False):
            whole = fits(a + b + waste)
            if whole is not None and whole >= a + b:
                return True
        return False

    def fill(items: Filling, left: int, upto: int) -> Iterator[Filling]:
        if not left:
            yield items
        for at in range(min(upto, bisect_right(order, left)) - 1, -1, -1):
            if not bits[at + 1] >> left & 1:
                return  # nor can the smaller ones make it
            s = order[at]
            for take in range(min(counts[s] - used[s], left // s), 0, -1):
                if bits[at] >> (left - take * s) & 1:
                    if not steps.spend():
                        return
                    used[s] += take
                    yield from fill((*items, *(s,) * take), left - take * s, at)
                    used[s] -= take

    room, waste = capacity - size, 0
    while waste <= min(room, spare()) and steps.left > 0:
        if bits[-1] >> (room - waste) & 1:
            for items in fill((), room - waste, len(bits) - 1):
                if (size, *items) not in barred and not dominated(items, waste):
                    yield (size, *items)
        waste += 1


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, effort: int = EFFORT) -> dict[Filling, int]:
    """Fillings (sizes of a sequence) with the number of sequences that get each.

    Bin completion over sizes with counts. The incumbent is best-fit decreasing; if it reaches
    the lower bound it is optimal. Else states are searched depth first: the largest size left must
    go somewhere, so each undominated filling around it is a branch, taken for as many bins as
    the counts allow and then for each smaller number. As later branches of a state do without the
    fillings before them beyond the number taken, these are barred there. A branch ends as soon as
    its waste exceeds what a packing of fewer bins than the incumbent's could afford.

    Two rounds: the first tries a few fillings per state, each as often as it goes, for a better
    incumbent; the second leaves none out and ends with an optimal packing, or after ``effort`` steps
    with the incumbent. The first also takes ``effort`` steps at most. The work depends on
    the number of different sizes, at most ``capacity``, and not on how many documents there are.
    """
    counts = {s: n for s, n in counts.items() if n > 0}
    if not counts:
        return {}
    best, bound = best_fit(counts, capacity), least_bins(counts, capacity)
    for whole in (False, True):
        if sum(best.values()) > bound:
            best = _search(counts, capacity, best, bound, _Steps(effort), whole)
    return best


def _search(counts: dict[int, int], capacity: int, best: dict[Filling, int], bound: int, steps: _Steps, whole: bool) -> dict[Filling, int]:
    """The best packing found from ``best`` on; with ``whole``, no branch is left out."""
    bins, waste = sum(best.values()), 0
    total, left, order = sum(s * n for s, n in counts.items()), dict(counts), sorted(counts)
    sums, barred = _Sums(capacity), set()
    path: list[tuple[Iterator[Filling], list[Filling], Filling | None, int, int]] = []  # branches, tried, taken, times, waste before

    def spare() -> int:
        return (bins - 1) * capacity - total - waste

    def branches() -> Iterator[Filling]:
        own = [s for s in order if left[s]]
        size = own[-1]
        left[size] -= 1
        if whole:
            options = fillings(left, own, size, capacity, sums.of(left, own), spare, barred, steps)
        else:
            options = iter([(size, *rest) for rest in first_fillings(left, own, capacity - size, steps)])
        left[size] += 1
        return options

    def step(taken: Filling, times: int) -> None:
        for s in taken:
            left[s] -= times

    path.append((branches(), [], None, 0, 0))
    while path and steps.left > 0 and bins > bound:
        options, tried, taken, times, before = path.pop()
        if taken is not None:
            step(taken, -times)
            waste = before
            times = times - 1 if whole else 0
        if not times:
            taken = next(options, None)
            if taken is None:
                barred.difference_update(tried)
                continue
            if whole:
                barred.add(taken)
                tried.append(taken)
            times = min(left[s] // n for s, n in Counter(taken).items())
        unused = capacity - sum(taken)
        if unused:
            times = min(times, spare() // unused)
        steps.spend()
        if times <= 0:
            path.append((options, tried, None, 0, waste))
            continue
        path.append((options, tried, taken, times, waste))
        step(taken, times)
        waste += unused * times
        if any(left.values()):
            path.append((branches(), [], None, 0, waste))
            continue
        packed: dict[Filling, int] = defaultdict(int)
        for _, _, filling, number, _ in path:
            if filling is not None:
                packed[filling] += number
        if sum(packed.values()) < bins:
            best, bins = dict(packed), sum(packed.values())
    return best


def _places(packed: dict[Filling, int]) -> tuple[np.ndarray, ...]:
    """Where the pieces of each size go, as sorted (size, first rank), first sequence, offset."""
    keys, sequences, offsets = [], [], []
    next_rank: dict[int, int] = defaultdict(int)
    sequence = 0
    for filling, number in sorted(packed.items(), reverse=True):
        offset = 0
        for size in filling:
            keys.append((size, next_rank[size]))
            sequences.append(sequence)
            offsets.append(offset)
            next_rank[size] += number
            offset += size
        sequence += number
    order = sorted(range(len(keys)), key=keys.__getitem__)
    at = np.array([keys[i] for i in order], np.int64).reshape(-1, 2)
    return at[:, 0], at[:, 1], np.array(sequences, np.int64)[order], np.array(offsets, np.int64)[order]


def pack(pieces: DataFrame, capacity: int = CAPACITY, effort: int = EFFORT, by_number: bool = False) -> DataFrame:
    """``pieces`` (any table with ``length``, from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    ``pieces`` must be a written table, as it is read more than once and its order numbers the
    rows. How many pieces there are of each length is all that reaches the driver, at most
    ``capacity`` numbers; they are packed as sizes. Pieces of a length are then numbered: within each
    task of the scan, moved by the counts of the tasks before, so no length, however common, is
    numbered in one task. The number finds the sequence and the place in it.

    With ``by_number`` the pieces bring ``task`` and ``own``, which are not returned, and no piece
    is shuffled unless the counts per length and task are too many to be broadcast: the way
    for pieces that carry their tokens.

    Pieces of equal length are interchangeable. An empty table gives an empty result.
    """
    names = [c for c in pieces.columns if not by_number or c not in ("task", "own")]
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    size, first, sequence, offset = _places(complete_bins(counts, capacity, effort))
    whole = F.struct(*(F.col(f"`{c}`") for c in names)).alias("piece_row")
    if by_number:
        rows = pieces.select(whole, F.col("length").alias("size"), "task", "own")
    else:
        rows = pieces.select(whole, F.col("length").alias("size"), F.monotonically_increasing_id().alias("row"))
        rows = rows.withColumn("task", F.shiftright("row", 33))
    by_task = rows.groupBy("size", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("size", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if by_number:
        base = written(base, "piece-counts")
        ranked = rows.join(F.broadcast(base) if few(base) else base, ["size", "task"]).withColumn("rank", F.col("base") + F.col("own"))
    else:
        own = F.row_number().over(Window.partitionBy("size", "task").orderBy("row")) - 1
        ranked = rows.join(base, ["size", "task"]).withColumn("rank", F.col("base") + own)
    width = int(first.max()) + 1 if len(first) else 1
    at = size * width + first

    @F.pandas_udf("sequence_id long, offset long")
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        s, r = sizes.to_numpy(np.int64), ranks.to_numpy(np.int64)
        if not len(s):
            return pd.DataFrame({"sequence_id": s, "offset": r})
        k = np.searchsorted(at, s * width + np.minimum(r, width - 1), "right") - 1
        return pd.DataFrame({"sequence_id": sequence[k] + r - first[k], "offset": offset[k]})

    placed = ranked.withColumn("place", place("size", "rank"))
    return placed.select("piece_row.*", "place.sequence_id", "place.offset")
