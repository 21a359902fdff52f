"""Packing, alignment and spelling against brute force, on small tables with awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from townform.llm import alignment, packing, spelling

DATA = "/root/testdata/sf0.001/documents.parquet"
ODD = [None, "", " ", "\n\n a\tb  c d", "Hello, wörld! it's", "日本語のテキスト", "x▁y", "<|endoftext|> <s> [UNK] <|startoftext|>", "á é", "İstanbul ΑΣ",
       "🙂🙂 ok", "ab" * 3000, "\x1c\x85 z", "word " * 6000, "ﬁne ½ ①"]


@pytest.fixture(scope="module")
def rows(spark):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(DATA).select("doc_id", "text").collect()]
    return given + [(10_000 + k, t) for k, t in enumerate(ODD)] + [(None, "no key"), (given[0][0], given[0][1]), (10_004, ODD[4])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    wide = [(i, t, "x", 1, "y") for i, t in rows]  # columns whose names the operators use themselves
    return spark.createDataFrame(wide, "doc_id long, text string, key string, row int, `a.b` string").repartition(4)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < -5")


# --- packing ------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("room", [4096, 50])
def test_packing(docs, rows, name, room):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    out = packing.packed(docs, path=path, room=room, most=8)
    got = out.collect()
    want = Counter()
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        want.update((i, k, at, np.array(ids[at:at + room], "<u4").tobytes()) for k, at in enumerate(range(0, len(ids), room)))
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids)
        filled[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for parts in filled.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:k]) for k in range(len(parts))] and sum(p[1] for p in parts) <= room
    total = sum(r.length for r in got)
    assert len(filled) <= 1.01 * -(-total // room) + 1
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(out).collect()}
    assert joined == {k: b"".join(p[2] for p in parts) for k, parts in filled.items()}


def test_plain_texts_take_the_shorter_way(rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, whole = packing.Encoder(path), Tokenizer.from_file(path)
    assert encode.merges.sound() and packing.Merges.of_file(public_tokenizers.path("byte_bpe_50k.json")) is None
    rng = random.Random(2)
    letters = "".join(map(chr, range(32, 127))) + "\n\n  ''\"ÀÉÖØßéöøÿ×÷abcdefghijklmnopqrstuvwxyz"
    texts = [t or "" for _, t in rows] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcs' .") for _ in range(30)) for _ in range(1000)] + list(whole.get_vocab()) + ["<|startoftext|>A", "<|StartOfText|>"]
    assert sum(packing.PLAIN.fullmatch(t) is not None for t in texts) > len(texts) / 2
    assert encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    broken = encode.merges
    broken.merges = [*broken.merges[:300], broken.merges[301], broken.merges[300], *broken.merges[302:]]
    assert not broken.sound()


def test_open_sequences_against_lists():
    """Best fit and the closing of the fullest, against a search through all open sequences."""
    rng = random.Random(3)
    bins, plain, number = packing.OpenSequences(100, 5), {}, 0
    for _ in range(3000):
        length = rng.choice([rng.randint(1, 100), rng.randint(1, 20)])
        fits = [s for s in plain.values() if s >= length]
        before = dict(plain)
        at, offset, closed = bins.place(length)
        if fits:
            assert before[at] == min(fits)
        else:
            assert at == number
            number += 1
            if len(before) == 5:
                assert closed and before[closed[0]] == min(before.values())
            plain[at] = 100
        assert offset == 100 - plain[at]
        plain[at] -= length
        for k in closed:
            del plain[k]
        assert all(plain.values()) and plain == bins.rest() and len(plain) <= 5


# --- alignment ----------------------------------------------------------------------

def plain_alignments(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = alignment.byte_level()
    size_a = lambda i: bytes(byte[c] for c in a.id_to_token(i))
    size_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    out = []
    for i, t in rows:
        ids = [a.encode(" " + (t or ""), add_special_tokens=False).ids, b.encode(t or "")]
        tokens = [[size_a(k) for k in ids[0]], [size_b(k) for k in ids[1]]]
        if not t or any(b"".join(s) != (" " + t).encode() for s in tokens):
            out.append((i, [[], []], []))
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in tokens]
        common = sorted(set(ends[0]) & set(ends[1]))
        cut = [[0] + [e.index(c) + 1 for c in common] for e in ends]
        out.append((i, ids, [(ids[0][p:q], ids[1][r:s]) for p, q, r, s in zip(cut[0], cut[0][1:], cut[1], cut[1][1:])]))
    return out


@pytest.mark.parametrize("pairs", [alignment.PAIRS, 0])
@pytest.mark.parametrize("ranks", [None, "byte_bpe_50k.tiktoken"])
def test_alignment(docs, rows, pairs, ranks):
    plain = plain_alignments(rows)
    links = [Counter((x, y) for one, other in groups for x in one for y in other) for _, _, groups in plain]
    count = Counter(p for l in links for p in l)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    want = Counter()
    for (i, ids, groups), l in zip(plain, links):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        want[(i, len(ids[0]), len(ids[1]), len(groups), sum(l.values()), sum(n for p, n in l.items() if count[p] == most[p[0]]),
              sum(n * count[p] for p, n in l.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "")] += 1
    got = alignment.scores(docs, pairs=pairs, ranks=ranks and public_tokenizers.path(ranks))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_forgotten_windows_come_back(monkeypatch):
    sides = [public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    align = alignment.Aligner(alignment.ByteLevel(sides[0]), alignment.Pieces(sides[1]))
    texts = [t or "" for t in ODD]
    first = [c.to_pylist() for c in align(texts)]
    align.forget()
    assert [c.to_pylist() for c in align(texts)] == first
    assert [c.to_pylist() for c in align(texts[::-1])] == [c[::-1] for c in first]
    align.forget()
    monkeypatch.setattr(alignment, "LARGE", 1)  # pairs of large groups are counted, not listed
    assert [c.to_pylist() for c in align(texts)] == first


# --- spelling -----------------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def plain_variants(rows, slips):
    counts = Counter()
    for i, t in rows:
        run = ""
        for c in (t or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\x7f" else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if slips and h % slips == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                counts[run] += 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        all_ = [(-m, v) for v, m in words.items() if abs(len(v) - len(w)) < 2 and near(w, v)]
        form = min(all_)[1] if all_ and -min(all_)[0] >= 5 * n else None
        out[w] = (form, n, len(all_), words[form] if form else None)
    root = lambda w: w if out[w][0] is None else root(out[w][0])
    return {(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


@pytest.fixture(scope="module")
def misspelled(rows):
    """Chains of forms, ties, accents, very long words, and words with equal letter counts."""
    rng = random.Random(8)
    extra = [(20_000, " ".join(["colour"] * 400 + ["colours"] * 80 + ["coloours"] * 16 + ["x" * 50 + "y"] * 60 + ["x" * 51 + "y"] * 6 + ["x" * 49 + "zy"] * 7)),
             (20_001, " ".join(["straße"] * 30 + ["strabe"] * 30 + ["strape"] * 6 + ["Ärgern"] * 40 + ["ärgern"] * 8 + ["ÄRGERN"] * 5 + ["×÷éèêë"] * 5))]
    for k in range(60):
        word = "".join(rng.choice("aeks") for _ in range(7))
        extra.append((30_000 + k, " ".join([word] * rng.choice([5, 9, 50]))))
    return rows[:120] + rows[200:] + extra


@pytest.mark.parametrize("slips", [0, 7])
@pytest.mark.parametrize("how", [{}, {"least": 3, "shards": 1000}])
def test_variants(spark, misspelled, slips, how):
    docs = spark.createDataFrame([(i, t, 1, "v") for i, t in misspelled], "doc_id long, text string, n int, word string").repartition(3)
    words = spelling.counted_words(docs, slips=slips)
    table = spelling.variants(docs, slips=slips, **({} if not how else {"least": 6}))
    if how:  # small shards: prefixes at all depths, and full vectors split by a hash
        near_ = {r.word: (r.near, r.form, r.form_n) for r in spelling.near_words(words, **how).collect()}
        want = {w: (k, f, m) for w, f, _, _, k, m in plain_variants(misspelled, slips)}
        assert set(near_) == {w for w, (k, _, _) in want.items() if k}
        assert all(near_[w][0] == want[w][0] and (want[w][1] is None or near_[w][1:] == want[w][1:]) for w in near_)
    else:
        assert set(map(tuple, table.collect())) == plain_variants(misspelled, slips) and table.count() == words.count()


def test_trie_splits_full_vectors(spark):
    words = spark.createDataFrame([(w, 5 + k) for k, w in enumerate({"".join(p) for p in __import__("itertools").permutations("abcabc")})], "word string, n long")
    plain = [r.word for r in words.collect()]
    assert len(spelling.heavy_nodes(words.withColumn("v", spelling.vector(F.col("word"))), 7)) > spelling.LEVELS - 2
    got = {r.word: r.near for r in spelling.near_words(words, least=7, shards=1 << 20).collect()}
    assert got == {w: k for w in plain if (k := sum(near(w, v) for v in plain))}


def test_empty(none):
    assert packing.packed(none).count() == 0 and packing.sequences(packing.packed(none)).count() == 0
    assert alignment.scores(none).count() == 0
    assert spelling.variants(none, slips=199).count() == 0
