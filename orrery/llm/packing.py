"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

The histogram has at most `capacity` entries, whatever the size of the data, so the program is solved on the driver:
  1. Multiplicative weights: each length's price is its length times a weight that falls exponentially with the part
     of its demand already covered; a knapsack dynamic program over the capacity finds the configuration of the
     highest price, which is used for a part of what its scarcest length has left.
  2. Rounding: each configuration's use is rounded down to a whole number of sequences.
  3. What rounding leaves is packed best-fit: the largest length first, then those that fill its
     sequence best, or always the next that fits, whichever needs fewer sequences.
Pieces then find their place by their rank among the pieces of their length, with one search in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, running_sums, stored
from .wordpieces import encoder

CAPACITY, END_ID = 4096, 1
#: Rounds of multiplicative weights, lengths behind that get a configuration in one round, part of the scarcest length
#: used up, rate of the weights.
ROUNDS, CHOSEN, STEP, RATE = 100, 24, 0.5, 3.0
#: Configurations are used whose lengths are worth this part of the best one at the first prices; without any, the
#: program ends.
FULL = 0.998

Config = tuple[tuple[int, int], ...]


def best_values(prices: np.ndarray) -> np.ndarray:
    """Knapsack dynamic program over all lengths: the highest total price within each capacity. prices[s] is that of the
    length s, 0 where there is none; a length may be taken any number of times."""
    capacity = len(prices) - 1
    # best[c] lies at capacity - c, so that all candidates of a capacity are one contiguous sum
    best, sums = np.zeros(capacity + 1), np.empty(capacity)
    for c in range(1, capacity + 1):
        best[capacity - c] = np.add(best[capacity - c + 1 :], prices[1 : c + 1], out=sums[:c]).max()
    return best[::-1]


def configuration(best: np.ndarray, prices: np.ndarray, most: np.ndarray, first: int = 0) -> dict[int, int]:
    """{length: how many} that reaches the best value, traced back from the dynamic program; with `first`, the best of
    those that hold that length. At most most[s] of a length are taken, the next best instead."""
    room, taken, allowed = len(best) - 1, {}, most > 0
    size = first
    while room > 0:
        if not size:
            value = np.where(allowed[1 : room + 1], best[room - 1 :: -1][:room] + prices[1 : room + 1], -1.0)
            size = room - int(value[::-1].argmax())  # of equal values the longest
            if value[size - 1] <= 0:
                break
        taken[size] = taken.get(size, 0) + 1
        if taken[size] >= most[size]:
            allowed[size] = False
        room, size = room - size, 0
    return taken


def starting_dual(demand: np.ndarray) -> np.ndarray:
    """Prices of the lengths of which no sequence can hold more than 1, by the best of three kinds of dual-feasible
    functions: the size itself; the size, but 1 for what leaves less than t of a sequence and 0 below t; and the size
    rounded down to a multiple of 1 / k after multiplication by k + 1."""
    capacity = len(demand) - 1
    size = np.arange(capacity + 1)
    tried = [size / capacity]
    tried += [np.where(size > capacity - t, 1.0, np.where(size < t, 0.0, size / capacity)) for t in np.unique(np.linspace(1, capacity // 2, min(256, max(1, capacity // 2)), dtype=int))]
    tried += [np.where((k + 1) * size % capacity == 0, size / capacity, (k + 1) * size // capacity / k) for k in range(1, 33)]
    return max(tried, key=lambda y: float((demand * y).sum()))


@dataclass
class Program:
    """used: fractional use of configurations ((length, how many), ...), never more than the demand. bound: no packing
    needs fewer sequences than this, the best dual value of the linear program that was met."""

    used: dict[Config, float]
    bound: float
    rounds: int


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Program:
    """Multiplicative weights for the covering program: minimise the number of sequences such that every length's demand
    is covered. The weights start from the best of some known dual solutions; that of a length falls exponentially with
    the part of its demand that is covered, and weight over demand is its price. The dynamic program gives the configuration of the highest
    price over all lengths. Prices divided by that value are a solution of the dual program, which bounds the optimum.

    One dynamic program serves several configurations: the best one, and the best with each of the lengths that are
    covered least. Each is used for a part of what its scarcest length has left.
    """
    demand = np.zeros(capacity + 1)
    demand[list(histogram)] = list(histogram.values())
    left, used, size = demand.copy(), {}, np.arange(capacity + 1)
    first_prices = starting_dual(demand)
    bound = float((demand * first_prices).sum())
    # whole numbers, so that equal prices stay equal; of equal ones, what fills more
    first_prices = np.where(demand > 0, np.rint(1000 * capacity * first_prices) + size, 0.0)
    enough = FULL * best_values(first_prices)[-1]
    fair = np.ceil(2 * demand * capacity / max(1.0, float((size * demand).sum()))) + 1  # twice its part of one sequence
    for done in range(rounds):
        live = left >= 1
        if not live.any():
            break
        covered = 1 - left / np.maximum(demand, 1)
        prices = np.where(live, first_prices * np.exp(-RATE * covered), 0.0)
        best = best_values(prices)
        bound = max(bound, float((demand * prices).sum()) / best[-1])
        behind = np.flatnonzero(live)[np.argsort(covered[live], kind="stable")[:CHOSEN]]
        full = False
        for first in [0, *behind.tolist()]:
            most = np.minimum(fair, np.floor(left))
            if first and most[first] < 1:
                continue
            config = configuration(best, prices, most, first)
            if sum(first_prices[s] * k for s, k in config.items()) < enough:
                continue
            full = True
            which, counts = np.array(list(config)), np.array(list(config.values()), float)
            use = max(1.0, STEP * float((left[which] / counts).min()))
            key = tuple(sorted(config.items(), reverse=True))
            used[key] = used.get(key, 0.0) + use
            left[which] -= use * counts
        if not full:
            break
    return Program(used, bound, done)


def configuration_program(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> dict[Config, float]:
    return solve(histogram, capacity, rounds).used


def round_and_finish(histogram: dict[int, int], used: dict[Config, float], capacity: int) -> list[tuple[Config, int]]:
    """(configuration, sequences) that hold every piece of the histogram exactly once."""
    left = dict(histogram)
    plan = []
    for config, use in used.items():
        if n := min(int(use + 1e-9), *(left[size] // k for size, k in config)):
            plan.append((config, n))
            for size, k in config:
                left[size] -= k * n
    ends = [_finish(left, capacity, fit) for fit in (best_fit, largest_fit)]
    return plan + min(ends, key=lambda e: sum(n for _, n in e))


def _finish(left: dict[int, int], capacity: int, fit) -> list[tuple[Config, int]]:
    left, plan = dict(left), []
    while any(left.values()):
        config = fit(left, capacity)
        n = min(left[s] // k for s, k in config)
        plan.append((config, n))
        for s, k in config:
            left[s] -= k * n
    return plan


def largest_fit(left: dict[int, int], capacity: int) -> Config:
    """The largest length left, then always as many as fit of the next one that still fits."""
    config = []
    for s in sorted((s for s, n in left.items() if n), reverse=True):
        if k := min(capacity // s, left[s]):
            config.append((s, k))
            capacity -= k * s
    return tuple(config)


def best_fit(left: dict[int, int], capacity: int) -> Config:
    """The largest length left, and with it those that fill the sequence best; large ones are preferred for that.

    Sums within the room are the bits of one number, so that a length is added to all of them by one shift.
    """
    sizes = sorted((s for s, n in left.items() if n), reverse=True)
    first, rest = sizes[0], capacity - sizes[0]
    mask, sums, steps = (1 << rest + 1) - 1, 1, []
    once = {s: min(left[s] - (s == first), rest // s, 1 if left[s] < 64 else 8) for s in sizes if s <= rest}
    more = {s: min(left[s] - (s == first), rest // s) - n for s, n in once.items()}
    for s, n in [*once.items(), *more.items()]:  # further copies only if single ones don't fill it
        if sums >> rest & 1:
            break
        for _ in range(n):
            steps.append((s, sums))
            sums |= sums << s & mask
    at, config = sums.bit_length() - 1, {first: 1}
    for s, before in reversed(steps):
        if not before >> at & 1:
            config[s] = config.get(s, 0) + 1
            at -= s
    return tuple(sorted(config.items(), reverse=True))


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Config, int]]:
    """Every round of the best-fit phase uses up a length, so the plan has at most rounds + capacity configurations,
    and a configuration at most about sqrt(2 * capacity) different lengths: a size that does not depend on the data."""
    return round_and_finish(histogram, configuration_program(histogram, capacity, rounds), capacity)


def _layout(plan: list[tuple[Config, int]]) -> dict[str, np.ndarray]:
    """For each (length, range of ranks): first sequence, how many of the length in one sequence, first offset."""
    rows, given, sequence = [], {}, 0
    for config, n in plan:
        at = 0
        for size, k in config:
            rows.append((size, given.get(size, 0), sequence, k, at))
            given[size] = given.get(size, 0) + k * n
            at += size * k
        sequence += n
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (a[:, 0] << 48) | a[:, 1], "rank": a[:, 1], "sequence": a[:, 2], "each": a[:, 3], "offset": a[:, 4]}


def place(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece"), rounds: int = ROUNDS) -> DataFrame:
    """pieces: rows with a length of 1 to `capacity`. Adds sequence_id and offset. Reruns agree, whatever the partitions;
    equal rows may change places."""
    spark = pieces.sparkSession
    rows = stored(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    layout = spark.sparkContext.broadcast(_layout(pack_histogram(histogram, capacity, rounds)))
    ranked = running_sums(rows.withColumn("one", F.lit(1).cast("long")), ["length"], list(order), ["one"], "ranked").drop("one")
    out = [c for c in ranked.columns if c != "before_one"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = layout.value
        for b in batches:
            size, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "before_one"))
            at = np.searchsorted(p["key"], (size << 48) | rank, "right") - 1
            turn = rank - p["rank"][at] if len(at) else rank
            seq = p["sequence"][at] + turn // p["each"][at]
            off = p["offset"][at] + turn % p["each"][at] * size
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in out], pa.array(seq), pa.array(off)], names=[*out, "sequence_id", "offset"])

    schema = ranked.drop("before_one").withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return arrow_map(ranked, run, schema)


def cut_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes every whole text (null: empty), appends end_id and cuts what is longer than the capacity:
    (id, piece, start, length, ids_crc32), and the ids themselves if asked for. The texts are not shuffled."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for b in batches:
            done = 0
            for k, flat, bounds in encode.texts(b.column("text"), end_id):
                n = np.diff(bounds)
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(k), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                at = np.append(bounds[doc] + start, len(flat))  # pieces lie one after the other
                view, places = memoryview(np.ascontiguousarray(flat)).cast("B"), (4 * at).tolist()
                crcs = [zlib.crc32(view[a:z]) for a, z in zip(places, places[1:])]
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int64)))] * with_ids
                ids = b.column("id").slice(done, k).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([ids, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crcs, pa.int64()), *lists], names=names)
                done += k

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, ddl)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and its offset there, gapless from 0. An empty text has the end id alone; an
    empty table gives an empty result; repeated ids are packed as separate documents."""
    return place(cut_documents(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed sequences themselves, from pack_documents(with_ids=True): (sequence_id, ids, doc_ids). A sequence has at
    most `capacity` ids, so no group is large."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
