"""Packing documents into sequences by cutting-stock column generation.

1. Each document is encoded once; whole sequences are cut off its front. The remainder is cut once more,
   at a multiple of the grain (``capacity / 64``). So the pieces of any corpus form a histogram of few
   lengths: multiples of the grain, and what is shorter than it.
2. A linear program over patterns (which pieces share a sequence) covers the histogram with the least
   padding. It starts from sequences of one length each; every better pattern comes from a knapsack over the dual
   prices, until their bound says that none can save more than ``GAP``. It runs on the histogram alone, so
   its work and memory do not grow with the documents.
3. Patterns are used a whole number of times. What rounding leaves, less than one sequence a pattern,
   is covered by filling sequences one after the other.
4. Where lengths do not fit together (all documents as long as each other, say), a share of the
   documents, no larger than it takes, has its remainder cut into powers of two, which fill any gap.
5. Each piece's rank among those of its length says which pattern, copy and place it gets. Ranks are
   counted in lots of bounded size, as many as the rows need, so one frequent length does not meet in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoremill.llm.bpe import ByteBpe
from scoremill.llm.common import in_arrow, no_nulls
from scoremill.llm.words import slices
from scoremill.sources.staging import setting, stage_observed

CAPACITY = 1024
SALTS = 64
LOT = 100_000            # rows of a lot, on average
ARROW_ROWS = 1000        # texts that a task hands to Python at once
SLICE_BYTES = 1 << 20    # of texts that are Python's strings at once
GRAINS = 64
GAP = 0.0005
ROUNDS = 5_000
WASTE = 0.005
SHARES = (0, 4, 16, 64)  # of 64 salts

Pattern = tuple[tuple[int, int], ...]  # (length, how often)


def padded(total: int, capacity: int) -> int:
    """Room a sequence takes: ``capacity``, or its own length at a power of two."""
    return total if total & (total - 1) == 0 else capacity


# --- the plan, on the histogram alone -------------------------------------------------------

def fullest(counts: dict[int, int], first: int, capacity: int) -> Pattern:
    """``first`` and what else fills a sequence best, within the counts: subset sums as bits.

    A length that occurs often enters as 1, 2, 4, ... copies of it.
    """
    mask, sums, steps = (1 << (capacity + 1)) - 1, 1 << first, []
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length] - (length == first), capacity // length), 1
        while left > 0 and not sums >> capacity & 1:
            copies = min(copies, left)
            steps.append((length, copies, sums))
            sums |= (sums << length * copies) & mask
            left -= copies
            copies *= 2
    total, chosen = sums.bit_length() - 1, {first: 1}
    for length, copies, old in reversed(steps):
        if not old >> total & 1:
            chosen[length] = chosen.get(length, 0) + copies
            total -= length * copies
    return tuple(sorted(chosen.items(), reverse=True))


def _one_after_another(demand: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Fill a pattern round the longest piece, use it until lengths run out, and go on."""
    left, out = {k: v for k, v in demand.items() if v > 0}, []
    while left:
        pattern = fullest(left, max(left), capacity)
        times = min(left[k] // n for k, n in pattern)
        for k, n in pattern:
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((pattern, times))
    return out


def _price(lengths: np.ndarray, duals: np.ndarray, cost: np.ndarray, capacity: int):
    """The pattern of least reduced cost, and the largest ratio of price to cost, by a knapsack table."""
    best = np.full(capacity + 1, -np.inf)
    best[0] = 0.0
    choice = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        n = int(np.searchsorted(lengths, room, "right"))
        if n:
            value = best[room - lengths[:n]] + duals[:n]
            k = int(np.argmax(value))
            best[room], choice[room] = value[k], k
    gain = best[1:] - cost[1:]
    room = int(np.argmax(gain)) + 1
    found, ratio = float(gain[room - 1]), float(np.max(best[1:] / cost[1:]))
    column = np.zeros(len(lengths))
    while room > 0:
        column[choice[room]] += 1
        room -= int(lengths[choice[room]])
    return column, found, ratio


@dataclass(frozen=True)
class Cover:
    """Patterns and how often (fractions allowed) each is used, the rounds of pricing it took, its room, and the least
    room that any cover needs by the last duals."""
    patterns: list[tuple[Pattern, float]]
    rounds: int
    room: float
    bound: float


def column_generation(demand: dict[int, int], capacity: int = CAPACITY, gap: float = GAP, rounds: int = ROUNDS) -> Cover:
    """The cover that meets every demand exactly with nearly the least room.

    Starts from patterns of one length each and prices new ones until no cover can be better by more than ``gap``.
    """
    lengths = np.array(sorted(demand), dtype=np.int64)
    if not len(lengths):
        return Cover([], 0, 0.0, 0.0)
    cost = np.array([padded(t, capacity) for t in range(capacity + 1)], dtype=float)
    often = capacity // lengths
    basis, inverse = np.diag(often.astype(float)), np.diag(1 / often)
    used, price = np.array([demand[int(k)] for k in lengths]) / often, cost[lengths * often]
    bound = float(sum(k * v for k, v in demand.items()))  # no padding at all
    done = 0
    while done < rounds and price @ used > bound * (1 + gap):
        column, gain, ratio = _price(lengths, price @ inverse, cost, capacity)
        done += 1
        bound = max(bound, float(price @ used) / max(ratio, 1.0))
        step = inverse @ column
        able = step > 1e-9
        if gain <= 1e-7 or price @ used <= bound * (1 + gap) or not able.any():
            break
        limits = np.where(able, used / np.where(able, step, 1), np.inf)
        out = int(np.argmin(limits))
        amount = limits[out]
        used = used - amount * step
        used[out] = amount
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
        basis[:, out] = column
        price[out] = cost[int(lengths @ column)]
    patterns = [(tuple((int(lengths[i]), int(basis[i, j])) for i in np.flatnonzero(basis[:, j])[::-1]), used[j])
                for j in range(len(used)) if used[j] > 1e-9]
    return Cover(patterns, done, float(price @ used), bound)


def whole_plan(demand: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and whole numbers of copies that hold every remainder exactly once."""
    left = {int(k): int(v) for k, v in demand.items() if v > 0}
    plan = []
    for pattern, times in column_generation(left, capacity).patterns:
        copies = min([int(times + 1e-6)] + [left[k] // n for k, n in pattern])
        if copies > 0:
            plan.append((pattern, copies))
            for k, n in pattern:
                left[k] -= n * copies
    return plan + _one_after_another(left, capacity)


def cuts(remainder: int, capacity: int, fine: bool) -> list[int]:
    """Lengths into which a remainder is cut, in order."""
    if fine:
        return [1 << k for k in range(remainder.bit_length() - 1, -1, -1) if remainder >> k & 1]
    grain = max(1, capacity // GRAINS)
    return [n for n in (remainder // grain * grain, remainder % grain) if n]


def best_plan(counts: dict[tuple[int, int], int], capacity: int = CAPACITY,
              waste: float = WASTE) -> tuple[int, list[tuple[Pattern, int]]]:
    """From how many documents have each (remainder, salt): below which salt remainders are cut fine,
    and the plan. The share cut fine is the smallest that keeps padding under ``waste``."""
    best = None
    for share in SHARES:
        demand: dict[int, int] = {}
        for (remainder, salt), n in counts.items():
            for length in cuts(remainder, capacity, salt < share):
                demand[length] = demand.get(length, 0) + n
        plan = whole_plan(demand, capacity)
        total = sum(k * n for k, n in demand.items())
        room = sum(padded(sum(k * n for k, n in p), capacity) * copies for p, copies in plan)
        if best is None or room < best[0]:
            best = (room, share, plan)
        if room - total <= waste * total or room <= total + capacity:
            break
    return best[1], best[2]


# --- pieces ---------------------------------------------------------------------------------

def encoded_documents(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, capacity: int = CAPACITY,
                      key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, doc_tokens, whole, coarse, fine``: check sums of the whole sequences at the front, and
    of the remainder's pieces under either way to cut it.

    A document is its identifiers and a final 0. The merges are run by ranks (four times as fast as the
    tokenizer file's own library, with the same result); a text that holds one of the tokenizer's added
    strings goes through that library itself.
    """
    added = _added(tokenizer)  # read here, so that no worker holds the tokenizer for the sake of these strings

    def cut(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        bpe = ByteBpe.cached(ranks, pattern)
        for part in slices(batch, "text", SLICE_BYTES):
            totals, whole, coarse, fine = [], [], [], []
            for t in part.column("text").to_pylist():
                if any(a in t for a in added):
                    from tokenizers import Tokenizer
                    ids = Tokenizer.from_file(tokenizer).encode(t, add_special_tokens=False).ids
                else:
                    ids = bpe.encoding.encode_ordinary(t)
                ids.append(0)
                content = np.array(ids, dtype="<u4").tobytes()
                size = len(ids)
                front = size - size % capacity
                totals.append(size)
                whole.append([zlib.crc32(content[4 * a:4 * (a + capacity)]) for a in range(0, front, capacity)])
                for out, finely in ((coarse, False), (fine, True)):
                    at, sums = front, []
                    for n in cuts(size - front, capacity, finely):
                        sums.append(zlib.crc32(content[4 * at:4 * (at + n)]))
                        at += n
                    out.append(sums)
            sums = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(totals, pa.int64()), pa.array(whole, sums),
                 pa.array(coarse, sums), pa.array(fine, sums)], ["doc_id", "doc_tokens", "whole", "coarse", "fine"])
    narrow = docs.select(F.col(key).alias("doc_id"), no_nulls(text).alias("text"))
    return in_arrow(narrow, cut, f"doc_id {dict(narrow.dtypes)['doc_id']}, doc_tokens bigint, "
                                 "whole array<bigint>, coarse array<bigint>, fine array<bigint>")


_added_strings: dict[str, list[str]] = {}


def _added(tokenizer: str) -> list[str]:
    if tokenizer not in _added_strings:
        from tokenizers import Tokenizer
        known = Tokenizer.from_file(tokenizer).get_added_tokens_decoder()
        _added_strings[tokenizer] = [t.content for t in known.values()]
    return _added_strings[tokenizer]


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0, among the pieces of the same length. No group is larger than a length's share of one lot."""
    counts = pieces.groupBy("length", "lot").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("lot").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("length", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("length", "lot").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = pieces.withColumn("nth", F.row_number().over(inside))
    return numbered.join(offsets, ["length", "lot"]).withColumn("rank", F.col("before") + F.col("nth") - 1)


def slots(plan: list[tuple[Pattern, int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length: from which rank, the first sequence, the copies, the first place in them."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, copies in plan:
        place = 0
        for length, often in pattern:
            at = ranks.get(length, 0)
            out.setdefault(length, []).append((at, sequence, copies, place))
            ranks[length] = at + often * copies
            place += length * often
        sequence += copies
    return out


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, capacity: int = CAPACITY,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is one piece of one token. Long texts are cut into as many pieces as they
    need. Rows that repeat are packed each for itself. No rows give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    # A number of its own for each row, written: rows that are equal in all else are told apart by it.
    numbered = encoded_documents(docs, tokenizer, ranks, pattern, capacity, key, text).withColumn("row", F.monotonically_increasing_id())
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS)):
        encoded, seen = stage_observed(numbered, "encoded", {"rows": F.count(F.lit(1))})
    lots = max(SALTS, -(-seen["rows"] // LOT))
    encoded = encoded.withColumns({"salt": F.pmod(F.xxhash64("row"), F.lit(SALTS)), "lot": F.pmod(F.xxhash64("row", F.lit(1)), F.lit(lots))})
    rest = F.col("doc_tokens") % capacity
    counts = {(r["rest"], r["salt"]): r["n"] for r in  # capacity * SALTS rows at most
              encoded.groupBy(rest.alias("rest"), "salt").agg(F.count(F.lit(1)).alias("n"))
              .filter("rest > 0").collect()}
    share, plan = best_plan(counts, capacity)

    finely = F.col("salt") < share
    ways = spark.createDataFrame(
        [(r, cuts(r, capacity, False), cuts(r, capacity, True)) for r in range(1, capacity)],
        "rest bigint, coarse_cut array<bigint>, fine_cut array<bigint>")
    cut = F.when(finely, F.col("fine_cut")).otherwise(F.col("coarse_cut"))
    sums = F.when(finely, F.col("fine")).otherwise(F.col("coarse"))
    pieces = (encoded.withColumn("rest", rest).join(F.broadcast(ways), "rest")
              .select("doc_id", "doc_tokens", "lot", "rest", F.posexplode(F.arrays_zip(
                  cut.alias("length"), sums.alias("crc"), _running(cut).alias("before"))).alias("at", "p"))
              .select("doc_id", (F.col("doc_tokens") - F.col("rest") + F.col("p.before")).alias("start"),
                      F.col("p.length").alias("length"), F.col("p.crc").alias("ids_crc32"), "doc_tokens", "lot"))

    rows = [(length, entries) for length, entries in slots(plan).items()]
    places = spark.createDataFrame(
        rows, "length bigint, slots array<struct<first:bigint, sequence:bigint, copies:bigint, place:bigint>>")
    slot = F.element_at(F.filter("slots", lambda s: s["first"] <= F.col("rank")), -1)
    at = F.col("rank") - F.col("slot.first")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    shared = (ranked(pieces).join(F.broadcast(places), "length").withColumn("slot", slot)
              .select(*columns, (F.col("slot.sequence") + at % F.col("slot.copies")).alias("sequence_id"),
                      (F.col("slot.place") + F.floor(at / F.col("slot.copies")).cast("bigint") * F.col("length"))
                      .alias("offset")))
    planned = sum(copies for _, copies in plan)
    alone = (encoded.select("doc_id", "doc_tokens", F.posexplode("whole").alias("at", "ids_crc32"))
             .select("doc_id", (F.col("at").cast("bigint") * capacity).alias("start"),
                     F.lit(capacity).cast("bigint").alias("length"), "ids_crc32", "doc_tokens",
                     (F.monotonically_increasing_id() + planned).alias("sequence_id"),
                     F.lit(0).cast("bigint").alias("offset")))
    return alone.unionByName(shared)


def _running(lengths):
    """The sum of the lengths before each."""
    return F.transform(lengths, lambda _, i: F.aggregate(
        F.slice(lengths, F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x))
