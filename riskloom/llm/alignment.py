"""Two tokenizations of each text laid side by side: groups of tokens with common ends, and the links between them.

Both tokenizers see a space and the text, so their tokens are spans of the same bytes. Every token points to the
overlapping token that ends farthest right (of two that end together, the second tokenizer's). Doubling these pointers
until nothing changes leads each token to the last one of its component, which labels the group. A link is a pair of
tokens, one of each side, that share a byte; pairs of ids are counted over the corpus, and each link is judged by the
count of its pair.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import pieces
from riskloom.session import Scratch, checked_broadcast

BATCH_BYTES = 256 << 10
#: Longer texts are encoded in parts, cut at single spaces between ASCII letters or digits.
PART_CHARS = 100_000
#: A task tells its pair counts whenever it holds this many distinct pairs.
TALLY_PAIRS = 1 << 20
#: The most frequent pairs go to every task; all others, each with at most 1 / HOT_PAIRS of all links, are joined.
HOT_PAIRS = 100_000
#: Fixed: how the piece file writes a space.
SPACE = "▁"
#: Fixed: how byte-level vocabularies cut words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond Latin, Greek and Cyrillic two libraries may know different letters, so such texts take the file's own one.
FAR = re.compile("[^\x00-\u04ff]")
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")

_sides: dict[str, Side] = {}
_names: list[str] = []


class Side:
    """A tokenizer as two functions of texts, and the bytes of each id."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            kept = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size())]
            self.bytes = [
                bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in kept
            ]
            self.encode = lambda texts: model.encode(texts, num_threads=1)
            # a space inside a piece would let it reach over a cut
            self.parts = not any(SPACE in p.lstrip(SPACE) for i, p in kept)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.encode_special_tokens = True
            byte_of = {c: b for b, c in _byte_letters().items()}
            kept = model.get_vocab(with_added_tokens=True)
            self.bytes = [b""] * (max(kept.values()) + 1)
            for token, i in kept.items():
                self.bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
            whole = lambda texts: [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
            quick = _quick(path, byte_of)
            self.encode = lambda texts: _encoded([" " + t for t in texts], whole, quick)
            self.parts = True
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    @classmethod
    def of(cls, path: str) -> Side:
        if path not in _sides:
            _sides[path] = cls(path)
        return _sides[path]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text with a space before it."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in _parts(text) if self.parts and len(text) > PART_CHARS else [text]:
                parts.append(part)
                owner.append(i)
        out: list[list] = [[] for _ in texts]
        for i, ids in zip(owner, self.encode(parts)):
            out[i].append(np.array(ids, np.int64))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def _quick(path: str, byte_of: dict[str, int]):
    """A faster encoder with the same ids for texts without ``FAR`` letters, if merges and ids of the file have one order."""
    with open(path) as f:
        file = json.load(f)
    model, cut = file["model"], file["pre_tokenizer"] or {}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", ())]
    ids = [model["vocab"][m.replace(" ", "")] for m in merged]
    usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    if file["normalizer"] or not usual or model.get("ignore_merges") or ids != sorted(ids):
        return None
    import tiktoken

    special = {t["content"] for t in file["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("merges", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary


def _encoded(texts: list[str], whole, quick) -> list[list[int]]:
    far = [quick is None or FAR.search(t) is not None for t in texts]
    encoded = iter(whole([t for t, f in zip(texts, far) if f]))
    return [next(encoded) if f else quick(t) for t, f in zip(texts, far)]


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


def _parts(text: str) -> list[str]:
    """``text`` cut at single spaces about every ``PART_CHARS``; the spaces go, as each part is given one in front."""
    out, start = [], 0
    while len(text) - start > PART_CHARS:
        cut = _CUT.search(text, start + PART_CHARS)
        if not cut:
            break
        out.append(text[start : cut.start()])
        start = cut.end()
    return out + [text[start:]]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of both sides the token of side B that ends its group; ends rise and the last ones are equal."""
    n = len(ends_a)
    to_b, to_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    itself = n + np.arange(len(ends_b))
    pointer = np.concatenate((n + to_b, np.where(ends_a[to_a] == ends_b, itself, to_a)))
    while True:
        farther = pointer[pointer]
        if np.array_equal(farther, pointer):
            return pointer[:n] - n, pointer[n:] - n
        pointer = farther


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers ``(a, b)`` of all pairs that share a byte."""
    starts_a = np.concatenate(([0], ends_a[:-1]))
    first = np.searchsorted(ends_b, starts_a, "right")
    n = np.searchsorted(ends_b, ends_a - 1, "right") - first + 1
    a = np.repeat(np.arange(len(ends_a)), n)
    return a, np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)


def _text_of(a, b, group_a, group_b, doc_a, doc_b, n_docs: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document."""
    n_groups = int(group_b[-1]) + 1 if len(group_b) else 0
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
    at_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
    n = len(a) + len(b)
    ids, group, side, doc = (np.empty(n, np.int64) for _ in range(4))
    for out, x, y in ((ids, a, b), (group, group_a, group_b), (side, 0, 1), (doc, doc_a, doc_b)):
        out[at_a], out[at_b] = x, y
    # the mark before a token: none, comma, bar or semicolon
    mark = np.zeros(n, np.int64)
    if n:
        new_group, new_side, new_doc = (x[1:] != x[:-1] for x in (group, side, doc))
        mark[1:] = np.where(new_doc, 0, np.where(new_group, 3, np.where(new_side, 2, 1)))
    most = int(ids.max(initial=0)) + 1
    if len(_names) < 4 * most:
        _names[:] = [m + str(i) for i in range(most) for m in ("", ",", "|", ";")]
    names = (ids * 4 + mark).tolist()
    cuts = np.searchsorted(doc, np.arange(n_docs + 1)).tolist()
    return ["".join(map(_names.__getitem__, names[x:y])) for x, y in zip(cuts, cuts[1:])]


def _ragged(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), pa.array(values, pa.int64())).cast(pa.list_(pa.int64()))


_ROWS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
_COLUMNS = [c.split()[0] for c in _ROWS.split(", ")]


def _aligned(path_a: str, path_b: str, digest: bool):
    def run(batches):
        one, two = Side.of(path_a), Side.of(path_b)
        shift = max(1, (len(two.bytes) - 1).bit_length())
        tally: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def told():
            codes, times = _summed(np.concatenate([c for c, _ in tally]), np.concatenate([t for _, t in tally]))
            cuts = np.array([0, len(codes)])
            nothing = [pa.nulls(1, t) for t in [pa.int64()] * 6 + [pa.string()]]
            return pa.RecordBatch.from_arrays([*nothing, _ragged(codes, cuts), _ragged(times, cuts)], _COLUMNS)

        for batch in pieces(batches, "text", BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            n = len(texts)
            able = [i for i in range(n) if texts[i]]
            some = [texts[i] for i in able]
            a, b = one.ids(some), two.ids(some)
            wanted = [(" " + t).encode() for t in some]
            same = [one.joined(x) == w and two.joined(y) == w for x, y, w in zip(a, b, wanted)]
            able = np.array([i for i, s in zip(able, same) if s], np.int64)
            a, b = [x for x, s in zip(a, same) if s], [x for x, s in zip(b, same) if s]
            n_a, n_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
            n_a[able], n_b[able] = [len(x) for x in a], [len(x) for x in b]
            doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
            ends_a, ends_b = np.cumsum(one.lengths[a]), np.cumsum(two.lengths[b])
            last_a, last_b = terminals(ends_a, ends_b)
            closing = np.unique(last_b)
            group_a, group_b = np.searchsorted(closing, last_a), np.searchsorted(closing, last_b)
            texts = _text_of(a, b, group_a, group_b, doc_a, doc_b, n)
            if digest:
                texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            left, right = overlaps(ends_a, ends_b)
            codes, link_doc = a[left] << shift | b[right], doc_a[left]
            order = np.lexsort((codes, link_doc))
            codes, link_doc = codes[order], link_doc[order]
            new = np.ones(len(codes), bool)
            new[1:] = (codes[1:] != codes[:-1]) | (link_doc[1:] != link_doc[:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(codes)))
            codes, pair_doc = codes[at], link_doc[at]
            cuts = np.searchsorted(pair_doc, np.arange(n + 1))
            n_links = np.bincount(link_doc, minlength=n)
            n_groups = np.bincount(doc_b[closing], minlength=n)
            numbers = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *numbers, pa.array(texts, pa.string()),
                 _ragged(codes, cuts), _ragged(times, cuts)], _COLUMNS)
            if len(codes):
                tally.append(_summed(codes, times))
                held += len(tally[-1][0])
            if held > 4 * TALLY_PAIRS:
                tally = [_summed(np.concatenate([c for c, _ in tally]), np.concatenate([t for _, t in tally]))]
                held = len(tally[0][0])
                if held > TALLY_PAIRS:
                    yield told()
                    tally, held = [], 0
        if tally:
            yield told()

    return run


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, rising, with the sum of their times."""
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1])))
    return codes[at], np.add.reduceat(times, at) if len(at) else times


def _scored(hot: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Sums over the links of hot pairs; the other pairs are handed on."""

    def run(batches):
        for batch in batches:
            pairs, times = (batch.column(c) for c in ("pairs", "times"))
            codes, weight = (np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.int64) for x in (pairs, times))
            cuts = np.concatenate(([0], np.cumsum(np.asarray(pairs.value_lengths().fill_null(0))))).astype(np.int64)
            at = np.minimum(np.searchsorted(hot, codes), max(len(hot) - 1, 0))
            known = hot[at] == codes if len(hot) else np.zeros(len(codes), bool)
            total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[cuts])
            sums = total(np.where(known, counts[at] * weight, 0)) if len(hot) else np.zeros(len(batch), np.int64)
            bests = total(np.where(known & best[at], weight, 0)) if len(hot) else np.zeros(len(batch), np.int64)
            rest = np.concatenate(([0], np.cumsum(~known)))[cuts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(bests, pa.int64()), pa.array(sums, pa.int64()),
                 _ragged(codes[~known], rest), _ragged(weight[~known], rest)],
                ["row", "n_best", "count_sum", "pairs", "times"])

    return run


def aligned(
    docs: DataFrame, path_a: str, path_b: str, digest: bool = False, hot_pairs: int = HOT_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """Aligned documents and counted pairs of ids, for ``docs(doc_id, text, …)`` and two tokenizer files.

    Documents: ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``, ``groups`` as ``a1,a2|b1;a3|b2,b3``
    or, with ``digest``, its SHA-256 ('' without tokens). Pairs: ``(a, b, n, best)``, ``n`` the links of the corpus that
    hold them and ``best`` whether no pair of that ``b`` has more.

    - null and empty texts, and texts whose tokens of a side do not join to the bytes of the text: zeros and '';
    - very long texts: whole, encoded in parts that no token reaches over; an unspaced one in one part;
    - null or repeated ids and repeated rows: a row for each; no rows: no rows; other columns are ignored;
    - strings of special tokens inside texts are plain text.
    """
    spark = docs.sparkSession
    shift = max(1, (len(Side.of(path_b).bytes) - 1).bit_length())
    with Scratch(spark, "alignment") as scratch:
        rows = docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        found = scratch.table(rows.mapInArrow(_aligned(path_a, path_b, digest), _ROWS), "found")
        each = lambda df: df.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
            "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
        pairs = scratch.table(each(found.where("row is null")).groupBy("pair").agg(F.sum("times").alias("n")), "pairs")
        b = F.col("pair").bitwiseAND(F.lit((1 << shift) - 1))
        # a row for each id of B
        most = checked_broadcast(pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most")))
        judged = pairs.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
        judged = scratch.table(judged, "judged")
        hot = judged.orderBy(F.desc("n"), "pair").limit(hot_pairs).toPandas().sort_values("pair")
        hot = [hot[c].to_numpy(t) for c, t in (("pair", np.int64), ("n", np.int64), ("best", bool))]
        kept = found.where("row is not null")
        sums = scratch.table(kept.select("row", "pairs", "times").mapInArrow(
            _scored(*hot), "row long, n_best long, count_sum long, pairs array<long>, times array<long>"), "sums")
        rest = each(sums.where(F.size("pairs") > 0)).join(judged, "pair").select(
            "row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
            (F.col("n") * F.col("times")).alias("count_sum"))
        sums = sums.select("row", "n_best", "count_sum").unionByName(rest)
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        kept = kept.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups").join(sums, "row")
        result = scratch.result(kept.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"))
        counted = judged.select(F.shiftright("pair", shift).alias("a"), b.alias("b"), "n", "best")
        return result, scratch.result(counted)
