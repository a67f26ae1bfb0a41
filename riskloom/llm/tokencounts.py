"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

A text's pre-tokens are its words with a leading word mark. The distinct pre-tokens of a batch are put into a trie of
bytes. The best score of a prefix does not depend on what follows it, so each node of the trie computes it once for all
pre-tokens that share the prefix: the maximum over the vocabulary pieces that end there of the ancestor's score plus the
piece's. The number of pieces on that best path is stored at the nodes where a pre-token ends; a text's count is their
sum. Bytes that no piece covers are pieces of their own with a score below all others.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import BASE, BYTE_WORDS, mix, pieces, powers, prefix_hashes, strings, word_spans

#: Fixed: what stands for the start of a word in the vocabulary file.
MARK = "▁".encode()
ZIPF_OFFSET = 10.0
BELOW_ALL = 10.0
BATCH_BYTES = 4 << 20
#: Longer pre-tokens, and those with a zero byte, are scored one by one.
TRIE_BYTES = 64

_MASK = (1 << 64) - 1
_WORDS = [int(x) for x in BYTE_WORDS]
_vocabularies: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces and their log probabilities, looked up by hash of their bytes.

    ``scores`` are kept as whole multiples of 2^-20, so that sums are exact and ties are ties on every machine.
    """

    UNIT = 1 << 20

    def __init__(self, scores: dict[bytes, float]):
        self.scores = {k: round(v * self.UNIT) for k, v in scores.items() if k}
        self.longest = max(map(len, self.scores), default=1)
        self.single = min(self.scores.values(), default=0) - round(BELOW_ALL * self.UNIT)
        for byte in range(256):
            self.scores.setdefault(bytes([byte]), self.single)
        keys = list(self.scores)
        hashes = self.hash_of(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], np.array([self.scores[k] for k in keys], np.int64)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces of the vocabulary have one hash")

    @staticmethod
    def hash_of(keys: list[bytes]) -> np.ndarray:
        sums = np.zeros(len(keys), np.uint64)
        for i, key in enumerate(keys):
            total = 0
            for byte in key:
                total = (total * BASE + _WORDS[byte]) & _MASK
            sums[i] = total
        return spread(sums, np.array([len(k) for k in keys], np.uint64))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, self.values[at]

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """The pieces of a sentencepiece file. Merge ranks become log probabilities by Zipf's law over the rank."""
        if path not in _vocabularies:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            special = (model.is_control, model.is_unknown, model.is_byte)
            ids = [i for i in range(model.get_piece_size()) if not any(f(i) for f in special)]
            ranked = all(model.get_score(i) == round(model.get_score(i)) for i in ids)
            score = (lambda s: -math.log(ZIPF_OFFSET - s)) if ranked else (lambda s: s)
            _vocabularies[path] = cls({model.id_to_piece(i).encode(): score(model.get_score(i)) for i in ids})
        return _vocabularies[path]

    def count(self, word: bytes) -> int:
        """Pieces of the best path of one pre-token; fewer pieces where scores are equal."""
        best = [(0, 0)] + [(0, 0)] * len(word)
        for end in range(1, len(word) + 1):
            ways = []
            for start in range(max(0, end - self.longest), end):
                score = self.scores.get(word[start:end])
                if score is not None:
                    ways.append((best[start][0] + score, best[start][1] - 1))
            best[end] = max(ways)
        return -best[-1][1]


def spread(sums: np.ndarray, length) -> np.ndarray:
    """Hash of a range from its polynomial sum and length."""
    return mix(sums + np.atleast_1d(np.asarray(length, np.uint64)) * np.uint64(0xD6E8FEB86659FD93))


def trie_counts(words: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Piece counts of distinct pre-tokens: rows of bytes padded with zeros, in byte order.

    Level by level: the row that first has a prefix is its node, the rows after it that share the prefix point to it.
    """
    n, deepest = words.shape
    common = np.zeros(n, np.int64)  # bytes shared with the row before
    if n > 1:
        differ = words[1:] != words[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), deepest)
        common[1:] = np.minimum(common[1:], np.minimum(lengths[1:], lengths[:-1]))
    up = [np.uint64(x) for x in powers(deepest + 1, "up")]
    node_of = [np.zeros(n, np.int64)]  # of each row, by level
    sums, scores, counts = [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    result = np.zeros(n, np.int64)
    for depth in range(1, deepest + 1):
        rows = np.flatnonzero((common < depth) & (lengths >= depth))
        if not len(rows):
            break
        new = np.zeros(n, np.int64)
        new[rows] = 1
        node_of.append(np.cumsum(new) - 1)
        level = sums[-1][node_of[depth - 1][rows]] * np.uint64(BASE) + BYTE_WORDS[words[rows, depth - 1]]
        best = np.full(len(rows), np.iinfo(np.int64).min)
        least = np.zeros(len(rows), np.int64)
        for size in range(1, min(depth, vocabulary.longest) + 1):
            before = node_of[depth - size][rows]
            known, value = vocabulary.look_up(spread(level - sums[depth - size][before] * up[size], size))
            score = scores[depth - size][before] + value
            count = counts[depth - size][before] + 1
            better = known & ((score > best) | ((score == best) & (count < least)))
            best, least = np.where(better, score, best), np.where(better, count, least)
        sums.append(level)
        scores.append(best)
        counts.append(least)
        ends = np.flatnonzero(lengths == depth)
        result[ends] = least[node_of[depth][ends]]
    return result


def pretoken_counts(tokens: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Piece counts of distinct pre-tokens in any order."""
    out = np.zeros(len(tokens), np.int64)
    lengths = np.array([len(t) for t in tokens], np.int64)
    plain = np.array([len(t) <= TRIE_BYTES and b"\0" not in t for t in tokens], bool)
    for i in np.flatnonzero(~plain):
        out[i] = vocabulary.count(tokens[i])
    short = np.flatnonzero(plain)
    if len(short):
        padded = np.array([tokens[i] for i in short], f"S{TRIE_BYTES}")
        order = np.argsort(padded, kind="stable")
        words = padded[order].view(np.uint8).reshape(len(short), TRIE_BYTES)
        out[short[order]] = trie_counts(words, lengths[short][order], vocabulary)
    return out


def _counted(path: str):
    def run(batches):
        vocabulary = Vocabulary.from_file(path)
        for batch in pieces(batches, "text", BATCH_BYTES):
            data, offsets = strings(batch.column("text"))
            starts, ends, first = word_spans(data, offsets)
            sums = prefix_hashes(data)
            hashes = spread((sums[ends] - sums[starts]) * powers(len(data) + 1, "down")[starts], ends - starts)
            _, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            buffer = data.tobytes()
            tokens = [MARK + buffer[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            per_word = np.concatenate(([0], np.cumsum(pretoken_counts(tokens, vocabulary)[inverse])))
            n_tokens = per_word[first[1:]] - per_word[first[:-1]]
            values = [batch.column("doc_id"), pa.array(np.diff(first)), pa.array(n_tokens)]
            yield pa.RecordBatch.from_arrays(values, ["doc_id", "n_pretokens", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_pretokens, n_tokens)`` for every row of ``docs(doc_id, text, …)``, with the vocabulary at ``path``.

    Rows stay where they are: every batch has its own trie, nothing is shuffled. Of segmentations with equal scores the
    one with fewer pieces counts.

    - null, empty and blank texts: 0; texts and single words of any length: whole;
    - null or repeated ids and repeated rows: a result for each row; no rows: no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(_counted(path), "doc_id long, n_pretokens long, n_tokens long")
