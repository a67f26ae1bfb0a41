"""Exact ranked search of documents for query texts, by sparse ball trees.

A document is a sparse vector over the terms that queries use: whole numbers that rise with the term's occurrences and
fall with the document's length; a query holds the weights of its terms, and the score is the inner product. Documents
are dealt to chunks, and each chunk is a tree of balls: a node knows the centre of its vectors and the distance of the
farthest one. No vector in a ball scores above the centre's score plus the query's length times that radius, rounded up,
so subtrees are visited best first and dropped once that bound is below the query's k-th best score so far. Documents at
the leaves are scored in whole numbers. Every task returns at most k rows a query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.texts import LOWER, mix, pieces, powers, prefix_hashes, strings, word_spans
from riskloom.session import Scratch

TOP = 10
#: Fixed: the terms of a text, and the same as a table of bytes in which all else is a space.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLDED = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    FOLDED[_low : _high + 1] = LOWER[_low : _high + 1]
#: Queries are searched in blocks of about this many terms, so that what a task is sent stays bounded.
BLOCK_TERMS = 8_192
#: A tree holds at most this many documents, postings, and numbers in the centres of its nodes.
CHUNK_DOCS, CHUNK_POSTINGS, CENTRE_NUMBERS = 16_384, 2_000_000, 6_000_000
LEAF = 32
HASHED_BYTES = 1 << 20


class Terms:
    """Distinct terms, numbered, and looked up by hash; the bytes decide."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms]).astype(np.int64)
        starts = ends - np.array([len(t) for t in terms], np.int64)
        hashes = _hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        self.data, self.starts, self.lengths = data, starts, ends - starts
        self.hashes, self.number = hashes[order], order
        self.most = int(np.unique(hashes, return_counts=True)[1].max(initial=0))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words that are terms, and the numbers of their terms."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = _hashes(data, starts, ends)
        at = np.searchsorted(self.hashes, hashes)
        words, numbers = [], []
        for more in range(self.most):  # once, unless two terms share a hash
            place = np.minimum(at + more, len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[place] == hashes)
            number = self.number[place[hit]]
            length = ends[hit] - starts[hit]
            fits = length == self.lengths[number]
            hit, number, length = hit[fits], number[fits], length[fits]
            inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            equal = data[np.repeat(starts[hit], length) + inner] == self.data[np.repeat(self.starts[number], length) + inner]
            if len(hit):
                equal = np.logical_and.reduceat(equal, np.cumsum(length) - length)
            words.append(hit[equal])
            numbers.append(number[equal])
        return np.concatenate(words), np.concatenate(numbers)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # some words at a time, as a hashed byte takes 40 times its room
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASHED_BYTES, "right")))
        base = starts[i]
        sums = prefix_hashes(data[base : ends[j - 1]])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[b] - sums[a]) * powers(len(sums), "down")[a] + (b - a).astype(np.uint64))
        i = j
    return out


def _words(column: pa.Array):
    data, offsets = strings(column)
    data = FOLDED[data]
    return data, *word_spans(data, offsets)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    data, starts, ends, _ = _words(pa.array([text or ""], pa.large_string()))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _postings(terms: list[bytes]):
    def run(batches):
        known = Terms(terms)
        for batch in pieces(batches, "text"):
            data, starts, ends, first = _words(batch.column("text"))
            words, numbers = known.find(data, starts, ends)
            doc = np.searchsorted(first, words, "right") - 1
            key, tf = np.unique(doc * max(len(terms), 1) + numbers, return_counts=True)
            doc, numbers = key // max(len(terms), 1), key % max(len(terms), 1)
            cuts = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(first), pa.int64()),
                 pa.ListArray.from_arrays(cuts, pa.array(numbers, pa.int32())),
                 pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int64()))],
                ["doc_id", "n", "terms", "tfs"])

    return run


class BallTree:
    """Documents as rows ``cuts`` of ``terms`` and whole ``values``, in order of the leaves; every row has a term."""

    def __init__(self, cuts: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray, leaf: int = LEAF):
        self.width, self.root_weights = len(weights), np.sqrt(weights.astype(np.float64))
        x = self.root_weights[terms] * values
        n = len(cuts) - 1
        size = np.add.reduceat(x * x, cuts[:-1]) if n else np.zeros(0)
        leaf = max(leaf, -(-4 * n * self.width // CENTRE_NUMBERS))
        self.order = np.arange(n)
        self.low, self.high, self.left, self.centres, self.spans, self.radii = [], [], [], [], [], []

        def node(low: int, high: int) -> int:
            rows = self.order[low:high]
            at, starts = _gather(cuts, rows)
            t, v = terms[at], x[at]
            centre = np.bincount(t, v, self.width) / len(rows)
            along = lambda p: np.add.reduceat(p[t] * v, starts)
            length = float(centre @ centre)
            away = size[rows] - 2 * along(centre) + length
            # what rounding may have taken from a distance is far below this share of the lengths
            radius = math.sqrt(max(0.0, float((away + 1e-9 * (size[rows] + length)).max()))) * (1 + 1e-9)
            top = np.zeros(self.width)
            np.maximum.at(top, t, v)
            here = len(self.low)
            for column, value in zip(
                (self.low, self.high, self.left, self.centres, self.spans, self.radii), (low, high, -1, centre, top - centre, radius)
            ):
                column.append(value)
            if high - low > leaf:
                # split where the line between two far points is cut in halves
                p, far = self._dense(cuts, terms, x, rows[int(away.argmax())]), None
                far = self._dense(cuts, terms, x, rows[int((size[rows] - 2 * along(p)).argmax())])
                half = len(rows) // 2
                self.order[low:high] = rows[np.argpartition(along(p - far), half)]
                todo.append((here, low + half, high))
                todo.append((here, low, low + half))
            return here

        todo = [(-1, 0, n)] if n else []
        while todo:
            parent, low, high = todo.pop()
            here = node(low, high)
            if parent >= 0:
                self.left[parent] = [here] if self.left[parent] == -1 else [*self.left[parent], here]
        at, _ = _gather(cuts, self.order)
        self.terms, self.values = terms[at], values[at]
        self.cuts = np.concatenate(([0], np.cumsum(np.diff(cuts)[self.order])))
        by_term = lambda x: np.ascontiguousarray(np.array(x).reshape(len(x), self.width).T)
        self.centres, self.spans = by_term(self.centres), by_term(self.spans)
        self.radii = np.array(self.radii)

    def _dense(self, cuts, terms, x, row) -> np.ndarray:
        out = np.zeros(self.width)
        out[terms[cuts[row] : cuts[row + 1]]] = x[cuts[row] : cuts[row + 1]]
        return out

    def search(self, query: np.ndarray, dense: np.ndarray, floor: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores of the leaves that may hold a score of ``floor`` or more; send a higher floor to go on with.

        ``query`` lists the terms, ``dense`` holds their weights and zeros.
        """
        if not len(self.radii):
            return
        y = self.root_weights[query]
        reach = np.minimum(math.sqrt(float(y @ y)) * self.radii, y @ self.spans[query])
        bounds = np.floor((y @ self.centres[query] + reach) * (1 + 1e-9) + 1)
        heap = [(-bounds[0], 0)]
        while heap and -heap[0][0] >= floor:
            _, at = heapq.heappop(heap)
            if self.left[at] != -1:
                for child in self.left[at]:
                    if bounds[child] >= floor:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            low, high = self.low[at], self.high[at]
            a, b = self.cuts[low], self.cuts[high]
            scores = np.add.reduceat(dense[self.terms[a:b]] * self.values[a:b], self.cuts[low:high] - a)
            floor = (yield self.order[low:high], scores) or floor


def _gather(cuts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ``rows``, and where each row begins among them."""
    n = cuts[rows + 1] - cuts[rows]
    starts = np.cumsum(n) - n
    return np.arange(n.sum()) + np.repeat(cuts[rows] - starts, n), starts


def _searched(queries: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """Best documents of each query ``(query, item_id, terms)`` among those of a task."""

    def run(batches):
        best: list[list[tuple[int, bool, int]]] = [[] for _ in queries]  # (-score, no id, id), best first
        dense = np.zeros(len(weights), np.int64)

        def take(ids, blank, cuts, terms, values):
            tree = BallTree(cuts, terms, values, weights)
            for top, (_, _, query) in zip(best, queries):
                dense[query] = weights[query]
                floor = -top[-1][0] if len(top) == k else 1
                leaves = tree.search(query, dense, floor)
                found = next(leaves, None)
                while found:
                    rows, scores = found
                    keep = scores >= floor
                    if keep.any():
                        top += zip((-scores[keep]).tolist(), blank[rows[keep]].tolist(), ids[rows[keep]].tolist())
                        top.sort()
                        del top[k:]
                        floor = -top[-1][0] if len(top) == k else 1
                    try:
                        found = leaves.send(floor)
                    except StopIteration:
                        found = None
                dense[query] = 0

        for ids, blank, cuts, terms, values in _chunks(batches, n_docs, n_terms):
            take(ids, blank, cuts, terms, values)
        rows = [(query, item, None if no else i, -score) for (query, item, _), top in zip(queries, best) for score, no, i in top]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else ([],) * 4, types)]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "item_id", "doc_id", "score"])

    return run


def _chunks(batches, n_docs: int, n_terms: int):
    """Rows with terms, as many at a time as a tree may hold: ids, which are null, cuts, terms and values."""
    held, docs, postings = [], 0, 0

    def joined():
        ids, blank, n, terms, values = (np.concatenate(x) for x in zip(*held))
        return ids, blank, np.concatenate(([0], np.cumsum(n))), terms, values

    for batch in batches:
        batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("terms")), 0))
        for start in range(0, batch.num_rows, CHUNK_DOCS):
            part = batch.slice(start, CHUNK_DOCS)
            count = part.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            if docs and (docs + len(count) > CHUNK_DOCS or postings + count.sum() > CHUNK_POSTINGS):
                yield joined()
                held, docs, postings = [], 0, 0
            tf = part.column("tfs").flatten().to_numpy(zero_copy_only=False)
            m = 100 - 90 + (90 * part.column("n").to_numpy(zero_copy_only=False) * n_docs) // n_terms
            values = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, count))
            terms = part.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = part.column("doc_id")
            held.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), count, terms, values))
            docs, postings = docs + len(count), postings + int(count.sum())
    if held:
        yield joined()


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best of ``docs(doc_id, text, …)`` for each of ``items(item_id, text, …)``.

    Terms are runs of ASCII letters and digits and of everything beyond ASCII, A-Z lower-cased. With N documents that have
    terms, L terms in all, n terms of a document, df documents of a term and tf occurrences, a document's score is the sum
    over the item's distinct terms of ``w * ((1000000000 tf) div (1000 tf + 8 m))``, where ``w = floor(1000 ln((2N + 2) /
    (2 df + 1)))`` and ``m = 100 - 90 + (90 n N) div L``. Scores of 0 are left out; equal ones go by rising ``doc_id``.

    Items are searched in blocks of about ``block_terms`` terms; each block reads the documents once.

    - null, empty and blank texts of either side: no terms, so no rows;
    - repeated rows and ids: documents and items for themselves; null document ids: after the others among equal scores;
    - very long texts: whole; no documents or no items: no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    with Scratch(spark, "lexical") as scratch:
        items = items.withColumn("terms", F.regexp_count("text", F.lit(TERM))).where("terms > 0")
        items = items.withColumn("query", F.monotonically_increasing_id())
        items = scratch.table(items, "items")
        total = items.agg(F.sum("terms")).first()[0] or 0
        blocks = max(1, -(-2 * total // block_terms))
        found = []
        for block in range(blocks):
            # a block's items are about half of block_terms terms, or one long item
            asked = items.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("query", "item_id", "text")
            queries = [(r.query, r.item_id, set(terms_of(r.text))) for r in asked.collect()]
            if not queries:
                continue
            terms = sorted(set().union(*(t for _, _, t in queries)))
            number = {t: i for i, t in enumerate(terms)}
            queries = [(q, i, np.array(sorted(number[t] for t in ts), np.int64)) for q, i, ts in queries]
            rows = scratch.table(
                docs.mapInArrow(_postings(terms), "doc_id long, n long, terms array<int>, tfs array<long>"), "postings"
            )
            n_docs, n_terms = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
            if not n_docs:
                break
            weights = np.full(len(terms), 0, np.int64)
            # a row for each term of the block
            for term, df in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
                weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            found.append(scratch.table(rows.mapInArrow(
                _searched(queries, weights, n_docs, n_terms, k), "query long, item_id long, doc_id long, score long"), "found"))
        if not found:
            empty = "item_id long, rank int, doc_id long, score long"
            return spark.createDataFrame([], empty)
        best = found[0]
        for more in found[1:]:
            best = best.unionByName(more)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return scratch.result(best.select("item_id", "rank", "doc_id", "score"))
