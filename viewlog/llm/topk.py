"""Operator 9, exact top-k search by Fagin's threshold algorithm.

Rows and queries are dealt into blocks of a fixed size by hash, and every pair
of a row block and a query block is one group: a stated query set against all
rows, in blocks. Within a group each dimension has a sorted list of the block's
rows. A query reads its lists from the end that its component's sign prefers,
scores every row that turns up (random access), and stops when the threshold,
the score of an imaginary row with the last value read of every list, is below
its k-th best score. Rows with equal scores at the cut are therefore always
seen. The k best of each block then give the k best of all.

Vectors are integers: floor(64 * x), each x as a double. Defined results: a
vector that is null or holds a null, NaN or infinite component takes no part,
nor does a row without an id; of rows that repeat an id, the least vector
stands for it; vectors of unequal length meet in the dimensions that both have;
an empty vector scores 0 with all; scores beyond 64 bits are held at the limit;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare

K = 20
SCALE = 64
#: Every row whose id is divisible by this is a query.
QUERY_EVERY = 20
#: Rows of a block of candidates, and of queries.
ROW_BLOCK = 4096
QUERY_BLOCK = 512
#: Depth of the lists that the first round reads; each round doubles it.
FIRST_DEPTH = 64
_LIMIT = (1 << 63) - 1


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v (doubles that hold whole numbers), one row per id."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) != float("inf")))
    whole = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(float(scale))).cast("double"))
    usable = rows.where(F.col(id_col).isNotNull() & x.isNotNull() & finite)
    return usable.groupBy(F.col(id_col).alias("vec_id")).agg(F.min(whole).alias("v"))


class SortedLists:
    """One block's rows and, for each dimension, their order by value."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")  # ties in score then fall to smaller ids
        self.ids, self.rows = ids[by_id], rows[by_id]
        self.lists = np.ascontiguousarray(np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32))  # dimension x rank
        self.largest = float(np.abs(self.rows).max(initial=0))

    def search(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, list[int]]:
        """(ids, scores) of the k best rows, best first."""
        exact = np.abs(query).sum() * self.largest < 2**53
        rows = self.rows if exact else self.rows.astype(object)
        q = query if exact else np.array([int(x) for x in query], dtype=object)
        used, up, down = np.flatnonzero(query), np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        n = len(self.ids)
        seen = np.zeros(n, dtype=bool)
        seen[self.ids == own_id] = True
        found, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=rows.dtype)
        depth, step = 0, FIRST_DEPTH
        while not seen.all():
            turned_up = np.zeros(n, dtype=bool)
            if len(used):
                turned_up[self.lists[up, max(0, n - depth - step) : n - depth]] = True
                turned_up[self.lists[down, depth : depth + step]] = True
            else:
                turned_up[:] = True  # a zero query scores 0 with all
            new = np.flatnonzero(turned_up & ~seen)
            seen[new] = True
            depth = min(depth + step, n)
            found = np.concatenate([found, new])
            # Many rows at once are scored faster without picking them out first.
            found_scores = (rows @ q)[new] if exact and 4 * len(new) > n else _int_rows(rows[new], exact) @ q
            scores = np.concatenate([scores, found_scores])
            if len(found) > k:
                if exact:  # those at or above the k-th score, then ties by id
                    top = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
                    found, scores = found[top], scores[top]
                    best = np.lexsort((found, -scores))[:k]
                else:
                    best = np.array(sorted(range(len(found)), key=lambda i: (-scores[i], found[i]))[:k])
                found, scores = found[best], scores[best]
            if depth >= n:
                break
            last = rows[self.lists[up, n - depth], up] @ q[up] + rows[self.lists[down, depth - 1], down] @ q[down]
            if len(found) == k and scores.min() > last:
                break
            step = depth
        order = sorted(range(len(found)), key=lambda i: (-scores[i], found[i]))
        return self.ids[found[order]], [max(-_LIMIT - 1, min(_LIMIT, int(scores[i]))) for i in order]


def _int_rows(rows: np.ndarray, exact: bool) -> np.ndarray:
    return rows if exact else np.vectorize(int, otypes=[object])(rows) if rows.size else rows


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    if (vectors.map(len) == width).all():
        return np.stack(vectors.to_list()).astype(np.float64)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : min(len(v), width)] = v[:width]
    return out


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs as ``integer_vectors`` gives them. A query never finds its own id."""
    prepare(rows.sparkSession)
    n_rows, n_queries = rows.count(), queries.count()
    row_blocks, query_blocks = -(-n_rows // ROW_BLOCK) or 1, -(-n_queries // QUERY_BLOCK) or 1
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias(own)
        return df.select("vec_id", "v", block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = dealt(queries, "query_block", query_blocks, "row_block", row_blocks)
    right = dealt(rows, "row_block", row_blocks, "query_block", query_blocks)

    def search(qs: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(qs) and len(block):
            width = max(max(map(len, qs["v"])), max(map(len, block["v"])))
            lists = SortedLists(block["vec_id"].to_numpy(), _matrix(block["v"], width))
            for own_id, q in zip(qs["vec_id"].tolist(), _matrix(qs["v"], width), strict=True):
                ids, scores = lists.search(q, own_id, k)
                out["query_id"] += [own_id] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores
        return pd.DataFrame(out)

    by = ["query_block", "row_block"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, f"query_id {id_type}, vec_id {id_type}, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


