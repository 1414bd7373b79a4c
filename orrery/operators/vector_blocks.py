"""Exact cosine search of a stated set of queries in blocks.

Vectors are packed, some thousand a row. Every block of queries meets every block of the corpus in a task, and what leaves
a task is what a result needs: the best rows of each query, or the best score of each owner, never a row for each pair. A
task holds one block of either side, their scores, and what is best so far. A matrix product says which pairs matter, with
an error far below the rounding that ranks them; these are worked out again, to the last bit as `scalars.cosine` does.

queries: (query_id, q, wanted); corpus: (id, owner, embedding). A row is relevant if its owner is the wanted one, null if
either is. Pairs of equal ids, or with a null id, are left out. `within` names a column of both tables whose values must
be equal. Vectors that are null, hold nulls or differ in length have the score null, which ranks last.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..arrow import arrow_map
from ..sources.sinks import written

#: Queries and corpus rows in a block, and bytes of a block's vectors at most.
QUERIES, ROWS, BYTES = 512, 4096, 4 << 20
#: Numbers that stand for scores: of a pair that is left out, of the score null, and of NaN, which is the greatest.
LEFT_OUT, NONE, NAN = -np.inf, -4.0, 4.0
_STEP, _OWNERS = 1 << 15, 1 << 22


def _packed(df: DataFrame, vector: str, prefix: str, rows: int) -> DataFrame:
    """A row for each block: the columns as lists, the vectors' lengths (-1: null or with nulls), and their numbers."""
    rest = [c for c in df.columns if c != vector]
    kind = "<f4" if df.schema[vector].dataType.elementType.typeName() == "float" else "<f8"
    names = [f"{prefix}{c}" for c in [*rest, "sizes", "numbers"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            while at < len(b):
                v = b.column(vector).slice(at, rows)
                sizes = pc.fill_null(pc.list_value_length(v), -1).to_numpy(zero_copy_only=False).astype(np.int32)
                take = max(1, min(len(v), BYTES // (8 * max(1, int(sizes.max())))))
                part, sizes = b.slice(at, take), sizes[:take].copy()
                v = part.column(vector)
                if v.flatten().null_count:
                    holed = np.unique(np.repeat(np.arange(take), np.maximum(sizes, 0))[v.flatten().is_null().to_numpy(zero_copy_only=False)])
                    sizes[holed] = -1
                    v = v.filter(pa.array(sizes >= 0))
                numbers = v.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes()
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays([*[one(part.column(c)) for c in rest], one(pa.array(sizes)), pa.array([numbers])], names=names)
                at += take

    kinds = [f"array<{df.schema[c].dataType.simpleString()}>" for c in rest]
    return arrow_map(df.select(*rest, vector), run, ", ".join(f"`{n}` {k}" for n, k in zip(names, [*kinds, "array<int>", "binary"])))


def _met(queries: DataFrame, corpus: DataFrame, per_block: int) -> DataFrame:
    """Every block of queries with every block of the corpus; a single one is broadcast, of more each is a partition."""
    n = max(1, -(-queries.count() // per_block))
    q = _packed(queries.repartition(n), "q", "q_", per_block).withColumn("q_block", F.monotonically_increasing_id())
    c = written(_packed(corpus, "embedding", "c_", ROWS), "vector-blocks", 4)  # read again for every block of queries
    return c.crossJoin(F.broadcast(q)) if n == 1 else c.crossJoin(q.hint("shuffle_replicate_nl"))


def _by_length(sizes: np.ndarray, numbers: bytes, kind: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length the places and vectors."""
    x, ends = np.frombuffer(numbers, kind).astype(np.float64), np.cumsum(np.maximum(sizes, 0))
    out = {}
    for d in np.unique(sizes[sizes >= 0]).tolist():
        at = np.flatnonzero(sizes == d)
        out[d] = at, x[((ends[at] - d)[:, None] + np.arange(d))]
    return out


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of two tables' rows, added one after the other, as a loop over the components does."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


class _Side:
    """The vectors of one length of one side of a block."""

    def __init__(self, at: np.ndarray, x: np.ndarray, n: int) -> None:
        self.at, self.x, self.place = at, x, np.full(n, -1)
        self.place[at] = np.arange(len(at))
        self.norm = np.sqrt(_added(x, x))
        self.odd = np.flatnonzero(~((self.norm > 1e-6) & (self.norm < 1e150)))
        self.unit = x / np.where(self.norm > 0, self.norm, 1.0)[:, None]


def exact_cosines(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, eps: float = 1e-12) -> np.ndarray:
    """Cosines of pairs of vectors, to the last bit those of `scalars.cosine`; NaN as its number."""
    out = np.empty(len(i))
    for z in range(0, len(i), _STEP):
        p, q = i[z : z + _STEP], j[z : z + _STEP]
        out[z : z + _STEP] = _added(a.x[p], b.x[q]) / np.maximum(a.norm[p] * b.norm[q], eps)
    out[np.isnan(out)] = NAN
    return out


def near_cosines(a: _Side, b: _Side) -> np.ndarray:
    """All pairs' cosines with an error of some 1e-15; those of vectors that are not of usual length are exact."""
    out = a.unit @ b.unit.T
    for i in a.odd.tolist():
        out[i] = exact_cosines(a, b, np.full(len(b.x), i), np.arange(len(b.x)))
    for j in b.odd.tolist():
        out[:, j] = exact_cosines(a, b, np.arange(len(a.x)), np.full(len(a.x), j))
    return out


def _codes(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where the values are; null is -1 in a and -2 in b."""
    x = pa.concat_arrays([a, b.cast(a.type)]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    left, right = x[: len(a)], x[len(a) :].copy()
    right[right < 0] = -2
    return left, right


def _rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """Half up in decimal, as Spark rounds."""
    values, at = np.unique(x, return_inverse=True)
    unit = Decimal(1).scaleb(-digits)
    return np.array([float(Decimal(repr(v)).quantize(unit, ROUND_HALF_UP)) for v in values.tolist()])[at]


class _Pairs:
    """Scores of one block with another."""

    def __init__(self, row: dict, kinds: tuple[str, str], within: bool) -> None:
        self.query_id, self.id, self.owner, self.wanted = (row[n] for n in ("q_query_id", "c_id", "c_owner", "q_wanted"))
        m, n = len(self.query_id), len(self.id)
        q, e = (_by_length(row[f"{p}_sizes"].to_numpy(), row[f"{p}_numbers"], k) for p, k in zip("qc", kinds))
        self.scores = s = np.full((m, n), NONE)
        self.sides = [(_Side(*q[d], m), _Side(*e[d], n)) for d in q.keys() & e.keys()]
        with np.errstate(all="ignore"):
            for a, b in self.sides:
                if len(a.x) == m and len(b.x) == n:
                    self.scores = s = near_cosines(a, b)
                else:
                    s[np.ix_(a.at, b.at)] = near_cosines(a, b)
        ids, asked = _codes(self.id, self.query_id)
        for at in np.flatnonzero(np.isin(ids, asked)).tolist():
            s[asked == ids[at], at] = LEFT_OUT
        s[:, ids < 0] = LEFT_OUT
        s[asked < 0] = LEFT_OUT
        if within:
            a, b = _codes(row["c_within"], row["q_within"])
            s[b[:, None] != a] = LEFT_OUT
        self.owners, self.wanteds = _codes(self.owner, self.wanted)

    def exact(self, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Scores of some pairs that are not left out, to the last bit."""
        out = np.full(len(q), NONE)
        with np.errstate(all="ignore"):
            for a, b in self.sides:
                i, j = a.place[q], b.place[c]
                on = (i >= 0) & (j >= 0)
                out[on] = exact_cosines(a, b, i[on], j[on])
        return out

    def relevant(self, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """1, 0, or -1 for null."""
        return np.where((self.owners[c] < 0) | (self.wanteds[q] < 0), -1, self.owners[c] == self.wanteds[q]).astype(np.int8)


class _Best:
    """The k best columns of each query by rounded score, then by their key, among all blocks of the corpus so far; with
    some more while scores are within rounding of the last one."""

    def __init__(self, m: int, k: int, digits: int) -> None:
        self.m, self.k, self.digits, self.margin = m, k, digits, 1.5 * 10.0**-digits
        self.low, self.held, self.n = np.full(m, LEFT_OUT), [], 0

    def add(self, s: np.ndarray, key: pa.Array, columns: dict, exact=None, of_pair=None) -> None:
        if not self.held and s.shape[1] > self.k:
            self.low = np.partition(s, s.shape[1] - self.k, axis=1)[:, s.shape[1] - self.k]
        q, c = np.nonzero(s >= np.maximum(self.low - self.margin, 2 * NONE)[:, None])
        at = pa.array(c)
        extra = {} if of_pair is None else {"relevant": pa.array(of_pair(q, c))}
        self.held.append(pa.table({"_q": pa.array(q), "_s": pa.array(s[q, c] if exact is None else exact(q, c)), "_key": key.take(at), **{n: x.take(at) for n, x in columns.items()}, **extra}))
        self.n += len(q)
        if self.n > 3 * self.m * self.k + ROWS:
            self.cut()

    def cut(self) -> pa.Table:
        t = pa.concat_tables(self.held).combine_chunks()
        place = lambda q: np.arange(len(q)) - np.searchsorted(q, q)  # noqa: E731  within its query
        order = np.lexsort((-t["_s"].to_numpy(), t["_q"].to_numpy()))
        t = t.take(pa.array(order))
        q, s = t["_q"].to_numpy(), t["_s"].to_numpy()
        last = place(q) == self.k - 1
        self.low[q[last]] = np.maximum(self.low[q[last]], s[last])
        t = t.filter(pa.array(s >= self.low[q] - self.margin))
        if len(t) > 2 * self.m * self.k:  # very many within rounding
            key = pc.rank(t["_key"].combine_chunks(), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
            order = np.lexsort((key, -_rounded(t["_s"].to_numpy(), self.digits), t["_q"].to_numpy()))
            t = t.take(pa.array(order))
            t = t.filter(pa.array(place(t["_q"].to_numpy()) < self.k))
        self.held, self.n = [t], len(t)
        return t


def _run(queries: DataFrame, corpus: DataFrame, within: str | None, schema: str, start, per_block: int | None = None) -> DataFrame:
    """start(ids of a block's queries, the first pairs' row) gives (add, flush): add takes the scores with each block of the
    corpus and may yield tables, flush yields what is left."""
    if within:
        queries, corpus = queries.withColumnRenamed(within, "within"), corpus.withColumnRenamed(within, "within")
    kinds = tuple("<f4" if d.schema[v].dataType.elementType.typeName() == "float" else "<f8" for d, v in ((queries, "q"), (corpus, "embedding")))
    met = _met(queries, corpus, per_block or QUERIES)
    names, inside = met.columns, bool(within)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, tuple] = {}
        for b in batches:
            for i in range(len(b)):
                row = {n: b.column(n)[i] for n in names}
                row = {n: x.as_py() if n == "q_block" or n.endswith("_numbers") else x.values for n, x in row.items()}
                if row["q_block"] not in blocks:
                    blocks[row["q_block"]] = start(row)
                for t in blocks[row["q_block"]][0](_Pairs(row, kinds, inside)) or ():
                    yield from t.to_batches()
        for _, flush in blocks.values():
            for t in flush():
                yield from t.to_batches()

    return arrow_map(met, run, schema)


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def decoded(score: Column) -> Column:
    return F.when(score == NAN, F.lit(float("nan"))).when(score != NONE, score)


def _ranked(rows: DataFrame, key: str, k: int, digits: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return rows.withColumn("score", F.round("score", digits)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).withColumn("score", decoded(F.col("score")))


def _rows_of(t: pa.Table, query_id: pa.Array, **more) -> pa.Table:
    """Columns of the output from a table of `_Best`."""
    one = {"query_id": query_id.take(t["_q"].combine_chunks()), "id": t["_key"], "owner": t["owner"]}
    relevant = t["relevant"].to_numpy()
    return pa.table({**one, "relevant": pa.array(relevant.astype(np.int32), mask=relevant < 0), "score": t["_s"], **{n: pa.array(np.full(len(t), v, np.int32)) for n, v in more.items()}})


def top_rows(queries: DataFrame, corpus: DataFrame, k: int, digits: int = 9, within: str | None = None, per_block: int | None = None) -> DataFrame:
    """The k best rows of each query, ties by id: (query_id, id, owner, relevant, score, rank)."""
    def start(row: dict) -> tuple:
        best, query_id = _Best(len(row["q_query_id"]), k, digits), row["q_query_id"]
        return lambda p: best.add(p.scores, p.id, {"owner": p.owner}, p.exact, p.relevant), lambda: [_rows_of(best.cut(), query_id)]

    schema = f"query_id {_type(queries, 'query_id')}, id {_type(corpus, 'id')}, owner {_type(corpus, 'owner')}, relevant int, score double"
    return _ranked(_run(queries, corpus, within, schema, start, per_block), "id", k, digits)


def owner_scores(queries: DataFrame, corpus: DataFrame, digits: int = 9, k: int | None = None, per_block: int | None = None) -> DataFrame:
    """The best score of each owner, for the k best owners of each query, ties by owner, with their rank, or for all:
    (query_id, owner, score)."""
    def start(row: dict) -> tuple:
        query_id, known, best = row["q_query_id"], None, None

        def add(p: _Pairs) -> list[pa.Table]:
            nonlocal known, best
            order = np.argsort(p.owners, kind="stable")
            begins = np.flatnonzero(np.diff(p.owners[order], prepend=-9))
            here, near = p.owner.take(pa.array(order[begins])), p.scores[:, order]
            s = np.maximum.reduceat(near, begins, axis=1)
            group = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(order)))
            q, c = np.nonzero((near >= s[:, group] - 1e-12) & (near > 2 * NONE))
            s = np.full(s.shape, LEFT_OUT)
            np.maximum.at(s, (q, group[c]), p.exact(q, order[c]))
            if known is None:
                known, best = here, s
                return []
            at = pc.index_in(here, known).to_numpy(zero_copy_only=False)  # null is found as a value of its own
            old = ~np.isnan(at.astype(float))
            places = at[old].astype(np.int64)
            best[:, places] = np.maximum(best[:, places], s[:, old])
            known, best = pa.concat_arrays([known, here.filter(pa.array(~old))]), np.hstack([best, s[:, ~old]])
            return flush() if best.size > _OWNERS else []

        def flush() -> list[pa.Table]:
            nonlocal known, best
            if known is None:
                return []
            if k is None or len(known) <= k:
                q, c = np.nonzero(best > 2 * NONE)
                t = pa.table({"_q": pa.array(q), "_s": pa.array(best[q, c]), "_key": known.take(pa.array(c))})
            else:
                few = _Best(len(query_id), k, digits)
                few.add(best, known, {})
                t = few.cut()
            known = best = None
            return [pa.table({"query_id": query_id.take(t["_q"].combine_chunks()), "owner": t["_key"], "score": t["_s"]})]

        return add, flush

    schema = f"query_id {_type(queries, 'query_id')}, owner {_type(corpus, 'owner')}, score double"
    best = _run(queries, corpus, None, schema, start, per_block).groupBy("query_id", "owner").agg(F.max("score").alias("score"))
    return best.withColumn("score", decoded(F.round("score", digits))) if k is None else _ranked(best, "owner", k, digits)


def judged(queries: DataFrame, corpus: DataFrame, k: int, digits: int = 9, per_block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, truth) as `search.judged` gives them: the k best rows of each query with rank and relevant, and, where it
    lies deeper, the first relevant one; n_relevant per query.

    One pass tells all but the rank of a first relevant row that lies deeper than k. Only the queries that have one are
    asked again, to count the rows before it.
    """
    def start(row: dict) -> tuple:
        query_id = row["q_query_id"]
        m = len(query_id)
        best, first, n, known = _Best(m, k, digits), _Best(m, 1, digits), np.zeros(m, np.int64), np.zeros(m, np.int64)

        def add(p: _Pairs) -> None:
            best.add(p.scores, p.id, {"owner": p.owner}, p.exact, p.relevant)
            there, told = p.scores > 2 * NONE, (p.wanteds >= 0)[:, None] & (p.owners >= 0)
            hit = p.wanteds[:, None] == p.owners
            n[:] += (there & hit).sum(1)
            known[:] += (there & told).sum(1)
            first.add(np.where(hit, p.scores, LEFT_OUT), p.id, {"owner": p.owner}, p.exact, p.relevant)

        def flush() -> Iterator[pa.Table]:
            for kind, t in ((0, best.cut()), (1, first.cut())):
                x = _rows_of(t, query_id, kind=kind)
                yield x.append_column("n", pa.nulls(len(x), pa.int64()))
            x = pa.table({"query_id": query_id, "id": pa.nulls(m, t["_key"].type), "owner": pa.nulls(m, t["owner"].type), "relevant": pa.nulls(m, pa.int32()), "score": pa.nulls(m, pa.float64()), "kind": pa.array(np.full(m, 2, np.int32)), "n": pa.array(n, mask=known == 0)})
            yield x.filter(query_id.is_valid())

        return add, flush

    schema = f"query_id {_type(queries, 'query_id')}, id {_type(corpus, 'id')}, owner {_type(corpus, 'owner')}, relevant int, score double, kind int, n long"
    found = written(_run(queries, corpus, None, schema, start, per_block), "judged-found")
    top = _ranked(found.filter("kind = 0"), "id", k, digits).select("query_id", "id", "rank", "relevant")
    place = F.struct((-F.round("score", digits)).alias("s"), F.col("id").alias("id"))
    told = found.filter("kind > 0").groupBy("query_id").agg(F.sum("n").alias("n_relevant"), F.min(F.when(F.col("kind") == 1, place)).alias("_first"))
    top, told = written(top, "judged-top"), written(told, "judged-truth")
    seen = top.filter("relevant = 1").select("query_id")
    deep = written(told.filter("_first is not null").join(seen, "query_id", "left_anti").select("query_id", (-F.col("_first.s")).alias("_s"), F.col("_first.id").alias("_id")), "judged-deep")
    rows = top.unionByName(_deep(queries, corpus, deep, digits, per_block)) if not deep.isEmpty() else top
    return rows, told.select("query_id", "n_relevant")


def _deep(queries: DataFrame, corpus: DataFrame, deep: DataFrame, digits: int, per_block: int | None) -> DataFrame:
    """The rank of a given row (score _s, id _id) of each query: 1 + the number of those before it."""
    def start(row: dict) -> tuple:
        query_id, s, first = row["q_query_id"], row["q__s"].to_numpy()[:, None], row["q__id"]
        n, margin = np.zeros(len(query_id), np.int64), 1.5 * 10.0**-digits

        def add(p: _Pairs) -> None:
            sure = p.scores > s + margin
            n[:] += sure.sum(1)
            q, c = np.nonzero((p.scores >= s - margin) & ~sure)
            if len(q):
                r = _rounded(p.exact(q, c), digits)
                order = pc.rank(pa.concat_arrays([p.id, first.cast(p.id.type)]), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
                before = (r > s[q, 0]) | ((r == s[q, 0]) & (order[c] < order[len(p.id) + q]))
                n[:] += np.bincount(q[before], minlength=len(n))

        return add, lambda: [pa.table({"query_id": query_id, "n": pa.array(n)})]

    # of a repeated query id only one is asked, as all rows with that id are asked about the same place
    asked = queries.join(deep, "query_id").dropDuplicates(["query_id"])
    before = _run(asked, corpus, None, f"query_id {_type(queries, 'query_id')}, n long", start, per_block).groupBy("query_id").agg(F.sum("n").alias("n"))
    return deep.join(before, "query_id").select("query_id", F.col("_id").alias("id"), (F.col("n") + 1).cast("int").alias("rank"), F.lit(1).alias("relevant"))
