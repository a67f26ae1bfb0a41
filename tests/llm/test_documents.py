"""Operators on documents against brute force, on odd rows and on none."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_words import LOWER, WORD, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

import corpus_pipeline
from riskloom.llm import language, minhash, mixing, packing, sharding, suffixes, tokencounts
from riskloom.llm.components import components
from riskloom.session import Scratch

WORDS = f"{corpus_pipeline.TOKENIZERS}/word_bpe_49k.json"
PIECES = f"{corpus_pipeline.TOKENIZERS}/piece_bpe_32k.model"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# near duplicates


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute_components(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i in range(len(docs)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        least[root(i)].append(doc_id)
    out = Counter()
    for i, (doc_id, _) in enumerate(docs):
        ids = [x for x in least[root(i)] if x is not None]
        component = (min(ids) if ids else None) if sets[i] else doc_id
        out[doc_id, len(sets[i]), component, doc_id == component] += 1
    return out


def near_rows(df):
    return rows(minhash.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept"))


def test_near_duplicates_of_odd_rows(odd_docs, odd_rows, no_docs):
    assert near_rows(odd_docs) == brute_components([r[:2] for r in odd_rows])
    assert not near_rows(no_docs)


@pytest.mark.parametrize("block", [512, 8])
def test_group_of_near_copies(spark, monkeypatch, block):
    """Copies of one text with 0 to 9 words changed: many pairs close to the limit, on both sides of it."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng, base = random.Random(5), words(120, 9).split()
    docs = []
    for i in range(80):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.randint(0, 5)):
            copy[at] = f"x{rng.randint(0, 10**6)}"
        docs.append((i * 7 % 80, " ".join(copy)))
    got = near_rows(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert got == brute_components(docs)


def test_components_of_random_links(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    parent = list(range(600))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    with Scratch(spark, "test") as scratch:
        got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "u long, v long"), scratch).collect()}
        assert components(spark.createDataFrame([], "u long, v long"), scratch).count() == 0
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}


# repeated byte strings


def brute_removal(docs, length):
    raw = [(t or "").encode() for _, t in docs]
    starts = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = Counter()
    for (doc_id, _), r in zip(docs, raw):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if starts[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[doc_id, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_repeated_bytes_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = rows(suffixes.repeated_bytes(odd_docs).select(COLUMNS))
    assert got == brute_removal([r[:2] for r in odd_rows], 200)
    assert not rows(suffixes.repeated_bytes(no_docs))


@pytest.mark.parametrize("group_segments", [1, 20_000])
def test_shared_passages(spark, group_segments):
    """Passages cut, shifted and edited; with one segment a group every group goes the way of the hot ones."""
    rng, passages, docs = random.Random(3), [words(30, 20 + i) for i in range(4)], []
    for i in range(60):
        parts = [words(rng.randint(1, 12), 100 + i)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, 40) : rng.randint(90, len(p))], words(rng.randint(0, 3), 1000 + i)]
        docs.append((i, "".join(parts)))
    docs.append((99, "abc" * 200))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = suffixes.repeated_bytes(df, length=60, gram=16, group_segments=group_segments)
    assert rows(got.select(COLUMNS)) == brute_removal(docs, 60)


def test_suffix_mergesort():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 3_000).astype(np.uint8)
    data[1000:1200] = data[2000:2200]
    s = suffixes.Suffixes(data, 50)
    starts = rng.permutation(2_900)[:700]
    block = np.sort(rng.integers(0, 9, 700))
    raw = data.tobytes()
    got = suffixes.merge_sorted(s, starts, block)
    want = sorted(zip(block, starts), key=lambda x: (x[0], raw[x[1] : x[1] + 50]))
    assert [raw[i : i + 50] for i in got] == [raw[i : i + 50] for _, i in want]
    assert sorted(got[block == 3]) == sorted(starts[block == 3])


def test_hot_windows_are_verified(spark):
    """With hashes of one bit nearly all windows collide; only those of equal bytes may be marked."""
    segments = [b"abcdXY", b"zabcdQ", b"123456", b"abcQRS"]
    cut = spark.createDataFrame(
        [(1, i, i, i, bytearray(b)) for i, b in enumerate(segments)] + [(2, 9, 9, 9, bytearray(b"123456"))],
        "anchor long, place int, d1 long, d2 long, bytes binary",
    )
    with Scratch(spark, "hot") as scratch:
        marks = suffixes._hot_marks(cut, ["anchor", "place", "d1", "d2"], 4, scratch, bits=1).collect()
    assert {(r.anchor, r.place, *sorted(r.ranges)) for r in marks} == {(1, 0, (0, 1)), (1, 1, (1, 2))}


# language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = docs.select("lang", language.held_out(F.col("doc_id")).alias("held_out"),
                        language.identify(F.col("text"), language.learn(docs)).alias("p"))
    right = found.where("held_out").select(F.avg((F.col("p.lang") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_of_odd_rows(odd_docs, no_docs):
    model = language.learn(odd_docs)
    assert set(model) <= {"en", "fr"} and not language.learn(no_docs)
    found = odd_docs.select("text", language.identify(F.col("text"), model).alias("p")).collect()
    for r in found:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.p.lang == "und") == blank and 0 <= r.p.score <= 1
    kept = language.in_known_language(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.where("text is null").count() == 0
    untaught = odd_docs.select(language.identify(F.col("text"), {}).alias("p")).select("p.lang").distinct()
    assert [r[0] for r in untaught.collect()] == ["und"]


# mixing


def test_mix_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = mixing.rates(odd_docs).select("row.doc_id", "row.source", "mix.*").collect()
    assert len(got) == len(odd_rows)
    total = sum(r["size"] for r in got)
    targets = {r.source: r.target for r in got}
    assert sum(targets.values()) == pytest.approx(total)
    for r in got:
        assert r.target <= 3 * r.source_size and 0 <= r.copies <= 3
    again = mixing.rates(odd_docs).select("row.doc_id", "row.source", "mix.*").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.emit(odd_docs).columns == odd_docs.columns
    assert mixing.emit(odd_docs).count() == sum(r.copies for r in got)
    assert mixing.rates(no_docs).count() == 0


# packing


def brute_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else capacity) - n)
    return len(gaps)


@pytest.mark.parametrize(("capacity", "part_pieces"), [(7, 100), (64, 1_000_000), (4096, 1_000_000)])
def test_pack_odd_rows(odd_docs, odd_rows, no_docs, capacity, part_pieces):
    tokenizer = Tokenizer.from_file(WORDS)
    got = packing.pack(odd_docs, WORDS, capacity, part_pieces).collect()
    want = Counter()
    for r in odd_rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want[r[0], k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) == brute_best_fit([r.length for r in got], capacity)
    assert packing.pack(no_docs, WORDS).count() == 0


def test_chunks_have_the_ids_of_whole_texts():
    tokenizer = Tokenizer.from_file(WORDS)
    odd = [
        "BELEDİYESİ,", "İ,", "İ", "হ\u09df,", "\u0958.", "\ufb2a,", "H̱", "J̌", "T̈,", "W̊", "0İ,0", "É0,", "ΟΔΟΣ,", "ﬁ.", "Ａ1'S",
        "ä's", "e\u0301,", "\u0301,", "a\u00a0b,", "\u3000", "日本語、0", "\u2028İ.", "Hello,", "don't", "x\u0000,", "٠,", "²", "a\tb.",
    ]
    rng = random.Random(6)
    texts = [*odd, *(" ".join(rng.choices(odd, k=40)) for _ in range(50))]
    marks = [chr(c) for c in range(0xC0, 0x3000)]
    texts += [" ".join(f"{a}{c}{b}" for c in marks) for a, b in (("", ","), ("A", ""), ("J", "\u030c!"), ("0", "0."))]
    got = packing.token_bytes(texts, WORDS)
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_best_fit_ranges_match_single_pieces():
    rng = random.Random(4)
    for _ in range(30):
        capacity = rng.randint(1, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 300))]
        placed = packing.best_fit(Counter(lengths), capacity)
        assert Counter({n: sum(p[2] for p in placed if p[0] == n) for n in set(lengths)}) == Counter(lengths)
        assert len({p[3] + i for p in placed for i in range(p[2])}) == brute_best_fit(lengths, capacity)


# sharding


def test_shards_of_odd_rows(odd_docs, odd_rows, no_docs):
    for bucket_bytes in (1 << 23, 10):
        got = sharding.shuffled(odd_docs, bucket_bytes=bucket_bytes).collect()
        assert Counter((r.row.doc_id, r.row.text) for r in got) == Counter(r[:2] for r in odd_rows)
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots[s]) for s in range(8)]
        assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(8))
    assert sharding.shuffled(no_docs).count() == 0


def test_shards_are_mixed(spark):
    docs = spark.range(4_000).selectExpr("id as doc_id", "'t' as text")
    got = sharding.shuffled(docs).select("row.doc_id", "shard", "slot").collect()
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(order, range(4_000))[0, 1]) < 0.1
    assert sum(a + 1 == b for a, b in zip(order, order[1:])) < 20


# token counts


def test_token_counts_of_odd_rows(odd_docs, odd_rows, no_docs):
    vocabulary = tokencounts.Vocabulary.from_file(PIECES)
    want = Counter()
    for r in odd_rows:
        tokens = WORD.findall(r[1] or "")
        want[r[0], len(tokens), sum(vocabulary.count(tokencounts.MARK + w.encode()) for w in tokens)] += 1
    assert rows(tokencounts.token_counts(odd_docs, PIECES)) == want
    assert not rows(tokencounts.token_counts(no_docs, PIECES))


def test_best_paths_match_another_unigram_model():
    """Scores of best paths against the lattice of the tokenizers library."""
    rng = random.Random(6)
    pieces = {c: rng.uniform(-9, -4) for c in "abc"} | {
        "".join(rng.choices("abc", k=rng.randint(2, 5))): rng.uniform(-8, -2) for _ in range(60)
    }
    model = Tokenizer(models.Unigram([("<unk>", -50.0), *pieces.items()], unk_id=0))
    vocabulary = tokencounts.Vocabulary({k.encode(): v for k, v in pieces.items()})
    tokens = sorted({"".join(rng.choices("abc", k=rng.randint(1, 30))) for _ in range(500)})
    counts = tokencounts.pretoken_counts([t.encode() for t in tokens], vocabulary)
    assert counts.tolist() == [len(model.encode(t).ids) for t in tokens]


def test_cache_of_unspaced_texts_stays_small():
    """Texts of one long chunk each do not pile up, and batches of new words end within the stated size."""
    rng = random.Random(8)
    tokenizer = Tokenizer.from_file(WORDS)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    packing._empty(WORDS)
    for i in range(0, 2000, 100):
        texts = ["".join(rng.choices(letters, k=7000)) for _ in range(100)]
        got = packing.token_bytes(texts, WORDS)
        assert got[0] == np.array(tokenizer.encode(texts[0], add_special_tokens=False).ids, "<u4").tobytes()
    _, cache, held = packing._tokenizer(WORDS)
    assert held[0] == 0 and len(cache) == 1


def test_cache_keeps_within_its_bytes(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_BYTES", 200_000)
    packing._empty(WORDS)
    for i in range(30):
        packing.token_bytes([words(300, i), "É" + words(50, i)], WORDS)
        _, cache, held = packing._tokenizer(WORDS)
        assert sum(len(k) + len(v) + packing.ENTRY_BYTES for k, v in cache.items()) - packing.ENTRY_BYTES <= 2 * held[0] <= 400_000


def test_capitals_beside_marks():
    """Capitals in texts beyond ASCII, with and without marks that compose with them."""
    rng = random.Random(4)
    tokenizer = Tokenizer.from_file(WORDS)
    near = [*"ABCJHTWYIKabcjhtwy.,'!#", *"ÉÀßÑİıΣσςЁйŒÅﬁ½Ωǅ漢ก়ড়য়"]
    marks = [chr(c) for c in (*range(0x300, 0x345), 0x0483, 0x05BC, 0x093C, 0x3099, 0x1DC0, 0x20D0, 0xFE20)]
    texts = []
    for i in range(3000):
        letters = near + (marks if i % 2 else marks[-6:])
        texts.append(" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(6)))
    got = packing.token_bytes(texts, WORDS)
    for text, ids in zip(texts, got):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
