"""Secrets in texts: fixed patterns, and a character convolutional network over every other candidate.

A candidate is a run of 12 or more of the characters that keys are made of, with a letter and a digit. The network sees
it whole, with the characters before and after it: five neighbouring characters at a time go through learned filters,
whose greatest answers (and, inside the candidate, mean answers) decide. It is trained on labelled findings, a bounded
number of them: what the patterns find in the corpus, and made ones of both kinds with and without a telling context. The
corpus candidates that the patterns do not find bear no label; those that a first network takes for harmless join the
harmless ones of a second. A part of the findings is held out; scores are calibrated there, and each shape of candidate
has the highest threshold that still finds the wanted share of its held-out secrets.

The patterns' findings always stay; the network adds to them.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import pieces
from riskloom.session import Scratch

#: Fixed: kinds in order, with the patterns of the first three.
KINDS = ("assign", "access", "hex", "net")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LEAST = 8
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: What the network is asked about.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
LETTER, DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
BEFORE, AFTER = 24, 8

#: At most so many findings of each label come from the corpus, and so many characters of each.
SAMPLE, SAMPLE_CHARS = 2_000, 256
MADE = 1_200
RECALL = 0.98
#: Shapes with fewer held-out secrets than this take the threshold of all shapes together.
SHAPE_LEAST = 20
SEED = 11
#: Characters that go through the filters at a time.
SLAB = 1 << 15
WINDOWS = 4_096

_SPAN = "struct<kind:int,start:long,end:long,score:double>"
_SEEN = "struct<kind:int,start:long,end:long,before:string,value:string,after:string>"


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(kind, start, end, start of the value)`` of the patterns' findings, each kind leftmost and not overlapping."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(0, *m.span(), m.start(1)) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(1, *m.span(), m.start()) for m in ACCESS.finditer(text)]
    return out + [(2, *m.span(), m.start()) for m in HEX.finditer(text)]


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if DIGIT.search(m[0]) and LETTER.search(m[0])]


def _seen(text: str) -> tuple[list[tuple], list[tuple]]:
    """The patterns' findings, and the candidates that overlap none of them."""

    def window(kind, start, end, at):
        return kind, start, end, text[max(0, at - BEFORE) : at], text[at:end], text[end : end + AFTER]

    base = base_spans(text)
    taken = sorted((s, e) for _, s, e, _ in base)
    free, i, reach = [], 0, 0
    for start, end in candidates(text):
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            free.append((start, end))
    return [window(*b) for b in base], [window(3, s, e, s) for s, e in free]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    item = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
                     + [(c, pa.string()) for c in ("before", "value", "after")])
    names = [f.name for f in item]
    for batch in pieces(batches, "text"):
        base, free = [], []
        for text in batch.column("text").to_pylist():
            b, f = _seen(text or "")
            base.append([dict(zip(names, x)) for x in b])
            free.append([dict(zip(names, x)) for x in f])
        columns = [batch.column("doc_id"), pa.array(base, pa.list_(item)), pa.array(free, pa.list_(item))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "free"])


# the network


def shape(value: str) -> int:
    """0 for lower-case hexadecimal digits, 1 for letters and digits, 2 for anything with other marks."""
    return 0 if re.fullmatch("[0-9a-f]*", value) else 1 if value.isalnum() else 2


def _codes(before: str, value: str, after: str) -> bytes:
    """A window as ASCII codes: two blanks, what is before, the value, what follows, two blanks."""
    edges = before[-BEFORE:].rjust(BEFORE, "\0"), after[:AFTER].ljust(AFTER, "\0")
    return f"\0\0{edges[0]}{value}{edges[1]}\0\0".encode("ascii", "replace")


WIDTH, LETTERS, FILTERS, HIDDEN, DEPTH = 5, 128, 16, 16, 8


@dataclass
class Net:
    """Weights of the network, its calibration ``sigmoid(slope * x + shift)`` and a threshold for each shape."""

    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple[float, float, float] = (0.5, 0.5, 0.5)

    @classmethod
    def new(cls, seed: int) -> Net:
        rng = np.random.default_rng(seed)
        size = lambda *s: rng.normal(0, 1 / np.sqrt(s[-2]), s)
        return cls({
            "letters": rng.normal(0, 0.5, (LETTERS, DEPTH)), "filters": size(WIDTH, DEPTH, FILTERS) / np.sqrt(WIDTH),
            "bias": np.zeros(FILTERS), "inner": size(4 * FILTERS + 1, HIDDEN), "inner_bias": np.zeros(HIDDEN),
            "outer": size(HIDDEN, 1)[:, 0], "outer_bias": np.zeros(1),
        })

    def tables(self) -> np.ndarray:
        """What each letter adds to each filter at each of the five places."""
        return np.einsum("cd,kdf->kcf", self.weights["letters"], self.weights["filters"])

    def pooled(self, windows: list[bytes]) -> np.ndarray:
        """Greatest answers before, inside and after the value, mean answers inside, and its length."""
        codes = np.frombuffer(b"".join(windows), np.uint8)
        lengths = np.array([len(w) for w in windows], np.int64)
        begin = np.cumsum(lengths) - lengths
        # zones of a window: blanks, before, value, after, blanks
        zones = np.stack([begin, begin + 2, begin + 2 + BEFORE, begin + lengths - 2 - AFTER, begin + lengths - 2], axis=1).ravel()
        tables = self.tables()
        most = np.zeros((len(zones), FILTERS))
        total = np.zeros((len(zones), FILTERS))
        for low in range(0, len(codes), SLAB):  # a long value goes through in parts
            high = min(low + SLAB, len(codes))
            at = np.clip(np.arange(low - 2, high + 2), 0, len(codes) - 1)
            near = codes[at]
            out = self.weights["bias"] + sum(tables[k][near[k : k + high - low]] for k in range(WIDTH))
            np.maximum(out, 0, out=out)
            first, last = np.searchsorted(zones, (low, high - 1), "right") - 1
            cuts = np.maximum(zones[first : last + 1], low) - low
            most[first : last + 1] = np.maximum(most[first : last + 1], np.maximum.reduceat(out, cuts))
            total[first : last + 1] += np.add.reduceat(out, cuts)
        most, total = most.reshape(-1, 5, FILTERS), total.reshape(-1, 5, FILTERS)
        inside = lengths - BEFORE - AFTER - 4
        return np.concatenate(
            [most[:, 1], most[:, 2], most[:, 3], total[:, 2] / inside[:, None], np.log(inside)[:, None] / 4], axis=1
        )

    def logits(self, windows: list[bytes]) -> np.ndarray:
        w, out = self.weights, []
        for group in _groups(windows):
            hidden = np.maximum(self.pooled(group) @ w["inner"] + w["inner_bias"], 0)
            out.append(hidden @ w["outer"] + w["outer_bias"])
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, windows: list[bytes]) -> np.ndarray:
        return _sigmoid(self.slope * self.logits(windows) + self.shift)


def _groups(windows: list[bytes]) -> Iterator[list[bytes]]:
    for i in range(0, len(windows), WINDOWS):
        yield windows[i : i + WINDOWS]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _gradients(net: Net, padded: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the mean log loss over a batch of windows, padded to one width."""
    w, n = net.weights, len(padded)
    wide = padded.shape[1] - 4
    tables = net.tables()
    out = w["bias"] + sum(tables[k][padded[:, k : k + wide]] for k in range(WIDTH))  # place p + 2 of a window
    np.maximum(out, 0, out=out)
    place = np.arange(wide)
    inside = lengths - BEFORE - AFTER - 4
    value = (place >= BEFORE) & (place < BEFORE + inside[:, None])
    after = (place >= BEFORE + inside[:, None]) & (place < BEFORE + AFTER + inside[:, None])
    peaks, features = [], []
    for zone in (np.broadcast_to(place < BEFORE, value.shape), value, after):
        peak = np.where(zone[:, :, None], out, -1).argmax(axis=1)
        peaks.append(peak)
        features.append(np.take_along_axis(out, peak[:, None], axis=1)[:, 0])
    features.append((out * value[:, :, None]).sum(axis=1) / inside[:, None])
    x = np.concatenate([*features, np.log(inside)[:, None] / 4], axis=1)
    before = x @ w["inner"] + w["inner_bias"]
    hidden = np.maximum(before, 0)
    wrong = (_sigmoid(hidden @ w["outer"] + w["outer_bias"]) - labels) / n
    back = wrong[:, None] * w["outer"] * (before > 0)
    to_x = back @ w["inner"].T
    to_out = value[:, :, None] * (to_x[:, None, 3 * FILTERS : 4 * FILTERS] / inside[:, None, None])
    rows, columns = np.arange(n)[:, None], np.arange(FILTERS)
    for i, peak in enumerate(peaks):
        np.add.at(to_out, (rows, peak, columns), to_x[:, i * FILTERS : (i + 1) * FILTERS])
    to_out *= out > 0
    flat = to_out.reshape(-1, FILTERS)
    to_tables = np.zeros_like(tables)
    for k in range(WIDTH):
        codes = padded[:, k : k + wide].ravel()
        for f in range(FILTERS):
            to_tables[k, :, f] = np.bincount(codes, flat[:, f], LETTERS)
    return {
        "letters": np.einsum("kcf,kdf->cd", to_tables, w["filters"]),
        "filters": np.einsum("kcf,cd->kdf", to_tables, w["letters"]),
        "bias": flat.sum(axis=0), "inner": x.T @ back, "inner_bias": back.sum(axis=0),
        "outer": hidden.T @ wrong, "outer_bias": wrong.sum(keepdims=True),
    }


def fit(findings: list[tuple[str, str, str, int]], epochs: int = 12, batch: int = 128, rate: float = 4e-3, recall: float = RECALL) -> Net:
    """A network for ``(before, value, after, label)``: every fourth finding is held out for calibration and thresholds."""
    findings = sorted(set(findings))
    random.Random(SEED).shuffle(findings)
    held, used = findings[::4], [f for i, f in enumerate(findings) if i % 4]
    net = Net.new(SEED)
    windows = [np.frombuffer(_codes(*f[:3]), np.uint8) for f in used]
    labels = np.array([f[3] for f in used], np.float64)
    rng = np.random.default_rng(SEED)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step = 0
    by_length = np.argsort([len(w) for w in windows], kind="stable")
    groups = [by_length[i : i + batch] for i in range(0, len(windows), batch)]
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            lengths = np.array([len(windows[i]) for i in groups[g]])
            padded = np.zeros((len(lengths), lengths.max()), np.int64)
            for row, i in zip(padded, groups[g]):
                row[: len(windows[i])] = windows[i]
            step += 1
            for name, slope in _gradients(net, padded, lengths, labels[groups[g]]).items():  # Adam
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.001 * (slope * slope - second[name])
                ahead = first[name] / (1 - 0.9**step)
                net.weights[name] -= rate * ahead / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    _calibrate(net, held, recall)
    return net


def _calibrate(net: Net, held: list[tuple[str, str, str, int]], recall: float) -> None:
    """Slope and shift by the held-out log loss, then the highest thresholds that keep the recall there."""
    labels = np.array([f[3] for f in held], bool)
    logits = net.logits([_codes(*f[:3]) for f in held])
    # targets short of 0 and 1, so that a clean split has a finite slope
    targets = np.where(labels, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((~labels).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's steps
        p = _sigmoid(a * logits + b)
        wrong, curve = p - targets, p * (1 - p) + 1e-9
        slopes = np.array([(wrong * logits).sum() + 1e-3 * (a - 1), wrong.sum()])
        cross = (curve * logits).sum()
        a, b = np.array([a, b]) - np.clip(np.linalg.solve([[(curve * logits**2).sum() + 1e-3, cross], [cross, curve.sum()]], slopes), -1, 1)
    net.slope, net.shift = float(a), float(b)
    scores = _sigmoid(net.slope * logits + net.shift)
    shapes = np.array([shape(f[1]) for f in held])

    def threshold(some: np.ndarray) -> float:
        mine = np.sort(scores[some & labels])
        return float(mine[int((1 - recall) * len(mine))]) if len(mine) else 1.0

    whole = threshold(np.ones(len(held), bool))
    enough = [(labels & (shapes == s)).sum() >= SHAPE_LEAST for s in range(3)]
    net.thresholds = tuple(threshold(shapes == s) if e else whole for s, e in enumerate(enough))


# labelled findings


def made_findings(n: int = MADE, seed: int = SEED) -> list[tuple[str, str, str, int]]:
    """``n`` made secrets and as many harmless runs, half of each with a telling context."""
    rng = random.Random(seed)
    some = lambda letters, low, high: "".join(rng.choices(letters, k=rng.randint(low, high)))
    word = lambda: some("etaoinshrdlu", 3, 9)
    hexadecimal, mixed = "0123456789abcdef", string.ascii_letters + string.digits
    secrets = (
        lambda: some(hexadecimal, 16, 64),
        lambda: some(mixed, 16, 48),
        lambda: some(mixed + "+/", 20, 64) + rng.choice(["", "=", "=="]),
        lambda: f"{some(string.ascii_lowercase, 2, 4)}_{rng.choice(['live', 'test', 'pat'])}_{some(mixed, 16, 40)}",
        lambda: ".".join(some(mixed + "_-", 12, 40) for _ in range(3)),
        lambda: some(string.ascii_uppercase + string.digits, 16, 24),
    )
    harmless = (
        lambda: f"{word()}{rng.randint(0, 99)}.{word()}.{rng.choice(['com', 'org', 'net'])}",
        lambda: f"{word()}/{rng.randint(1990, 2030)}/{word()}-{rng.randint(0, 9999):04}.{rng.choice(['csv', 'txt', 'html'])}",
        lambda: f"{word()}_{word()}_{rng.randint(0, 9999)}",
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}-00-00",
        lambda: f"{word()}-{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}-{rng.choice(['beta', 'rc', 'dev'])}{rng.randint(0, 9)}",
        lambda: f"{word()}{word()}{rng.randint(0, 9999)}",
        lambda: f"{rng.randint(10, 99)}{rng.choice(['th', 'px', 'km'])}-{word()}-{word()}",
        lambda: f"{word()}={rng.randint(0, 9999)}.{word()}={rng.randint(0, 9999)}",
    )
    telling = ('key = "', "Authorization: Bearer ", "credential: ", "auth=", "pwd: ", "private_key: '", "access ")
    plain = ("see ", "www.", "file ", "at ", "version ", "from ", "call ", "the ", "in ")
    out = []
    for i in range(n):
        before = rng.choice(telling) if i % 2 else word() + " " + rng.choice(plain)
        out.append(((word() + " " + before)[-BEFORE:], rng.choice(secrets)(), rng.choice(['"', " ", ".", "\n"]) + word(), 1))
        before = rng.choice(plain) if i % 2 else word() + " "
        out.append(((word() + " " + before)[-BEFORE:], rng.choice(harmless)(), rng.choice([" ", ",", "\n"]) + word(), 0))
    return out


def corpus_windows(seen: DataFrame, name: str, sample: int = SAMPLE) -> list[tuple[str, str, str]]:
    """At most ``sample`` different windows ``(before, value, after)`` of column ``name``, in order of their hash."""
    rows = seen.select(F.explode(name).alias("x")).select(
        "x.before", F.substring("x.value", 1, SAMPLE_CHARS).alias("value"), "x.after"
    )
    h = F.xxhash64("before", "value", "after")
    rows = rows.distinct().orderBy(h, "before", "value", "after").limit(sample).collect()
    return [(r.before, r.value, r.after) for r in rows if r.value]


def learned(found: list[tuple[str, str, str]], free: list[tuple[str, str, str]]) -> Net:
    """The network for a corpus whose patterns found ``found`` and whose other candidates are ``free``.

    Every other finding loses what is before it, so that the network learns the values, too.
    """
    labelled = made_findings() + [("" if i % 2 else b, v, a, 1) for i, (b, v, a) in enumerate(found)]
    first = fit(labelled)
    scores = first.scores([_codes(*w) for w in free])
    harmless = [(*w, 0) for w, score in zip(free, scores) if score < 0.5]
    return fit(labelled + harmless) if harmless else first


def _judged(net: Net):
    def run(batches):
        span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            free = batch.column("free")
            counts = free.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = free.flatten()
            before, value, after, start, end = (flat.field(c).to_pylist() for c in ("before", "value", "after", "start", "end"))
            scores = net.scores([_codes(*w) for w in zip(before, value, after)])
            limits = np.array(net.thresholds)[[shape(v) for v in value]] if len(value) else np.zeros(0)
            owner = np.repeat(np.arange(len(counts)), counts)
            added: list[list] = [[] for _ in counts]
            for i in np.flatnonzero(scores >= limits).tolist():
                added[owner[i]].append({"kind": 3, "start": start[i], "end": end[i], "score": float(scores[i])})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("base"), pa.array(added, pa.list_(span))], ["doc_id", "base", "added"]
            )

    return run


def scan(docs: DataFrame, net: Net | None = None, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, spans)`` for each row of ``docs(doc_id, text, …)``; ``spans`` are ``(kind, start, end, score)`` by start.

    ``kind`` numbers ``KINDS``; starts and ends count code points. The patterns' spans have score 1. Candidates that overlap
    none of them are scored by ``net``, or by a network fitted to ``made_findings`` and a bounded sample of ``docs``.

    - null and empty texts: no spans; very long texts and runs: whole;
    - null or repeated ids and repeated rows: a result for each row; equal findings count once in training;
    - no rows: no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    with Scratch(docs.sparkSession, "secrets") as scratch:
        seen = scratch.table(docs.mapInArrow(_extract, f"doc_id long, base array<{_SEEN}>, free array<{_SEEN}>"), "seen")
        net = net or learned(corpus_windows(seen, "base", sample), corpus_windows(seen, "free", sample))
        judged = seen.mapInArrow(_judged(net), f"doc_id long, base array<{_SEEN}>, added array<{_SPAN}>")
        base = F.transform("base", lambda x: F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end"), F.lit(1.0).alias("score")))
        # by start, then kind
        flip = lambda a, b: F.when(a.start != b.start, F.signum(a.start - b.start)).otherwise(F.signum(a.kind - b.kind)).cast("int")
        return scratch.result(judged.select("doc_id", F.array_sort(F.concat(base, "added"), flip).alias("spans")))
