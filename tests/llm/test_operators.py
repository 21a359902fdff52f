"""Operators against brute force and exact round trips, on small tables with awkward rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from townform.llm import (chat, decontaminate, exact_dedup, language_id, mixing, ngram_jaccard, repeats, tables, toxicity, url_filters, warc)

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 8, 40, 120, 300])) for _ in range(60)]
    texts = list(base)
    for t in base[:30]:  # near copies: a few words changed
        words = t.split()
        for _ in range(max(1, len(words) // 60)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 20)}" for _ in range(12)]
    texts += base[:5] * 3 + ["", "   ", None, None, "one", "One", "two words", "é" * 150, "ab" * 400, "x" * 900, prose(rng, 9000)]
    out = [(i, t, rng.choice(["a", "b", None])) for i, t in enumerate(texts)]
    return out + [(7, out[7][1], out[7][2]), (None, "lost words of no row", "a"), (None, base[3], None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = [(i, t, s, "x", 1) for i, t, s in rows]  # columns whose names the operators use themselves
    return spark.createDataFrame(extra, "doc_id long, text string, source string, node string, size int").repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < -5")


def grams(text, n):
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if c < "\x7f" else c for c in text or ""))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80)])
def test_jaccard_components(docs, rows, n, num):
    sets = [(i, grams(t, n)) for i, t, _ in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if i is not None and j is not None and a and 100 * len(a & b) >= num * len(a | b):
            low, high = sorted((find(i), find(j)))
            root[high] = low
    got = sorted(map(tuple, ngram_jaccard.linked_groups(docs, n, num, 100).collect()), key=str)
    assert got == sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)
    stay = [r.doc_id for r in ngram_jaccard.one_of_each(docs, n, num, 100).collect()]
    assert Counter(stay) == Counter(i for i, _ in sets if i is None or find(i) == i)


def test_large_families_ship_each_row_once_a_turn(spark, monkeypatch, tmp_path):
    rng = random.Random(11)
    base = prose(rng, 200).split()
    texts = []
    for i in range(120):  # near copies, one family
        words = list(base)
        words[rng.randrange(200)] = f"own{i}"
        texts.append(" ".join(words))
    ends = [[f"own{i}x{k}" for k in range(400)] for i in range(60)]
    passages = [prose(rng, 60) for _ in range(20)]
    texts += [" ".join([*own, *rng.sample(passages, 4)]) for own in ends]  # do not link, but parts agree
    texts += [" ".join([*ends[i][2:], texts[120 + i][-900:]]) for i in range(6)]
    texts += [" ".join(f"few{i // 2}y{k}" for k in range(30 + 3 * (i % 2))) for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sets = [grams(t, 5) for t in texts]
    root = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
    product, stage, names = ngram_jaccard._product, ngram_jaccard.staged, []

    def counted(num, den, **how):
        run, log = product(num, den, **how), tmp_path / f"bits {bool(how)}"
        log.mkdir()

        def counting(batches):
            def passed():
                for batch in batches:
                    (log / f"{random.SystemRandom().random()}").write_text(str(batch.num_rows))
                    yield batch
            yield from run(passed())
        return counting

    monkeypatch.setattr(ngram_jaccard, "_product", counted)
    monkeypatch.setattr(ngram_jaccard, "staged", lambda df, name: names.append(name) or stage(df, name))
    monkeypatch.setattr(ngram_jaccard, "BLOCK_ROWS", 24)
    monkeypatch.setattr(ngram_jaccard, "TURN_BYTES", 0, raising=False)
    got = ngram_jaccard.linked_groups(docs, 5, 80, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))
    assert sum(int(f.read_text()) for f in (tmp_path / "bits False").iterdir()) <= 5 * 120 + 12 + 10  # blocks times rows
    assert names.count("links") == 4 + 5  # a turn ships what all rows take once; of the bits the last two of 5 fit one


def test_turns_ship_all_pairs_within_bounds():
    room = {1: 500, 3: 90, 7: 400}
    parts = ngram_jaccard.turns(room, 990)
    assert [low for low, _ in parts] == [0, *(high for _, high in parts[:-1])] and parts[-1][1] == 7
    for low, high in parts:
        assert high == low + 1 or sum(size for t in range(low, high) for blocks, size in room.items() if blocks > t) <= 990
    assert ngram_jaccard.turns({1: 500}, 500) == [(0, 1)] and ngram_jaccard.turns({2: 5}, 5) == [(0, 1), (1, 2)]


def test_parities_never_rule_out_a_link():
    import numpy as np
    rng = np.random.default_rng(4)
    for num in (80, 90):
        sets = []
        for size in (1, 5, 60, 64, 65, 128, 130, 700, 2000):
            one = rng.integers(0, 1 << 62, size, dtype=np.uint64)
            for share in (0, 0.05, 0.1, 0.12, 0.3):
                gone = int(size * share)
                for more in (0, gone):
                    sets.append(np.unique(np.concatenate([one[gone:], rng.integers(0, 1 << 62, more, dtype=np.uint64)])))
        sizes = np.array([len(s) for s in sets])
        bits = ngram_jaccard.parities(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)]))
        nodes, none = np.arange(len(sets)), np.zeros(len(sets), int)
        got = ngram_jaccard.near(nodes, none, sizes, bits, num, 100)
        linked = ngram_jaccard.forest(nodes, none, sets, num, 100)
        root = list(nodes)
        for a, b in got:
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
        assert all(root[a] == root[b] for a, b in linked) and len(linked) > 20
        assert len(set(root)) >= 8  # sets of other texts stay apart


def test_stages_remove_their_exchanges(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before = files()
    assert len(tables.staged(spark.range(1000).repartition(5, "id"), "any").collect()) == 1000
    for _ in range(50):
        if not (left := {f for f in files() - before if f.startswith("shuffle_") and f.endswith(".data")}):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(tables.CLEANUP) == "false"
    with tables.passing(spark.range(10), "any") as some:
        path = Path(urlparse(some.inputFiles()[0]).path).parent
        assert len(some.collect()) == 10 and path.exists()
    assert not path.exists()


def test_repeated_strings(docs, rows):
    texts = [(t or "").encode() for _, t, _ in rows]
    seen = Counter(t[s:s + 200] for t in texts for s in range(len(t) - 199))
    want = []
    for (i, _, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for s in range(len(t) - 199):
            if seen[t[s:s + 200]] > 1:
                gone[s:s + 200] = [True] * 200
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, repeats.without_repeats(docs).collect()), key=str) == sorted(want, key=str)


def test_passage_in_thousands_of_documents(spark, monkeypatch):
    import pyarrow as pa
    rng = random.Random(8)
    passage = prose(rng, 90).encode()
    texts = [b"%s %s %s" % (prose(rng, 60).encode(), passage, prose(rng, 60).encode()) for _ in range(3000)]
    texts += [b"%s %s" % (t[-260:], prose(rng, 50).encode()) for t in texts[:20]] + [t[100:700] for t in texts[20:40]]
    rows = [(i, t.decode()) for i, t in enumerate(texts)]
    seen = Counter(t[s:s + 200] for t in texts for s in range(len(t) - 199))
    want = {}
    for i, t in enumerate(texts):
        gone = bytearray(len(t))
        for s in range(len(t) - 199):
            if seen[t[s:s + 200]] > 1:
                gone[s:s + 200] = b"\1" * 200
        want[i] = (sum(gone), hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest())
    shipped, cut = [], repeats._cut_snippets

    def counting(*how):  # runs in this process as well, to see what would go to one group
        shipped.append(how)
        return cut(*how)

    monkeypatch.setattr(repeats, "_cut_snippets", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.without_repeats(docs).collect()
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in got} == want
    names = pa.array(range(len(texts)), pa.int64())
    found = list(repeats._find_anchors(8)(iter([pa.RecordBatch.from_arrays([names, pa.array(texts, pa.binary())], ["node", "text"])])))
    marks = defaultdict(list)
    for batch in repeats._flag_anchors(iter(found)):
        for node, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            marks[node].append(m)
    batch = pa.RecordBatch.from_arrays([names, pa.array(texts, pa.binary()), pa.array([marks[i] for i in range(len(texts))], pa.list_(pa.binary()))],
                                       ["node", "text", "marks"])
    keys = Counter()
    for out in cut(*shipped[0])(iter([batch])):
        for kind, payload in zip(out.column(0).to_pylist(), out.column(4).to_pylist()):
            if kind == repeats.ANCHOR:
                n = int.from_bytes(payload[:8], "little")
                keys.update(repeats.np.frombuffer(payload[8:8 + n * repeats.SNIPPET.itemsize], repeats.SNIPPET)["key"].tolist())
    assert keys and max(keys.values()) <= 2048


def test_exact_groups(docs, rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    best = lambda ids: max((i for i in ids if i is not None), default=None)
    want = [(i, best(groups[t or ""]), len(groups[t or ""]), i == best(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t, _ in rows]
    assert sorted(map(tuple, exact_dedup.exact_groups(docs).collect()), key=str) == sorted(want, key=str)
    assert exact_dedup.keep_one(docs).count() == len(groups)


def test_mixture(docs, rows):
    out = mixing.mixture(docs).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _, _ in rows)
    by = defaultdict(list)
    for r in out:
        assert r.taken in (0, r.size, 2 * r.size)
        by[r.source].append(r)
    total = sum(r.size for r in out)
    assert abs(sum(rs[0].target for rs in by.values()) - 1.5 * total) < 1e-6 * total
    for rs in by.values():
        size = sum(r.size for r in rs)
        assert rs[0].source_size == size and rs[0].target <= 2 * size + 1e-6
        rest, reach = rs[0].target - (rs[0].target // size) * size, 1
        for r in rs:
            reach |= reach << r.size
        best = max(s for s in range(int(rest) + 2) if reach >> s & 1)
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= rest - best + 3
    assert sorted(map(str, out)) == sorted(map(str, mixing.mixture(docs.repartition(3)).collect()))
    assert mixing.targets([10, 100], [9, 1], 60) == [20, 40]


def test_fit_counts_is_best():
    rng = random.Random(1)
    for _ in range(50):
        lengths = rng.sample(range(1, 40), 4)
        counts = [rng.randrange(1, 5) for _ in lengths]
        budget = rng.randrange(sum(n * c for n, c in zip(lengths, counts)))
        take = mixing.fit_counts(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts)) and sum(n * t for n, t in zip(lengths, take)) <= budget
        assert budget - sum(n * t for n, t in zip(lengths, take)) <= max(lengths)


def test_fit_counts_against_all_sums():
    rng = random.Random(3)
    cases = [([200_000 + i for i in range(10)], [1] * 10, 1_030_000), ([7, 10], [3, 4], 34), ([0, 6, 10], [5, 3, 4], 33)]
    for k in range(60):
        lengths = sorted(rng.sample(range(1, 40) if k % 2 else range(100_000, 400_000), 5))
        counts = [rng.randrange(1, 4) for _ in lengths]
        cases.append((lengths, counts, rng.randrange(sum(n * c for n, c in zip(lengths, counts)))))
    for lengths, counts, budget in cases:
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + k * n for s in sums for k in range(c + 1)}
        take = mixing.fit_counts(lengths, counts, budget)
        assert all(0 <= x <= c for x, c in zip(take, counts))
        assert sum(n * x for n, x in zip(lengths, take)) == max(s for s in sums if s <= budget)


@pytest.mark.parametrize("most", [1 << 20, 60])
def test_contamination(spark, docs, rows, most):
    rng = random.Random(9)
    long = rows[85][1].split()
    items = [(1, " ".join(long[5:25])), (2, "one"), (10, "Two  WORDS"), (3, prose(rng, 30)), (4, None), (5, ""), (6, " ".join(long[5:25])), (None, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c < "\x7f" else c for c in t or ""))
    windows = [(k, tuple(w[i:i + 13])) for k, t in items if (w := split(t)) for i in range(max(1, len(w) - 12))]
    want = []
    for i, t, _ in rows:
        words, hit, found = split(t), set(), set()
        for k, w in windows:
            for p in range(len(words) - len(w) + 1):
                if tuple(words[p:p + len(w)]) == w:
                    hit.update(range(p, p + len(w)))
                    found.add("null" if k is None else str(k))
        want.append((i, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                     bool(hit) and 20 * len(hit) >= len(words)))
    got = decontaminate.contamination(docs, bench, most=most)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    kept = decontaminate.clean(docs, bench, most=most)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    assert decontaminate.contamination(docs, bench.where("item_id > 99")).where("n_hit > 0").count() == 0


def test_windows_of_items(spark):
    items = [("a", "one two three four"), ("a", "One two three four"), ("b", "x"), (None, "two three four"), ("c", ""), ("d", None)]
    found = decontaminate.windows(spark.createDataFrame(items, "item_id string, text string").repartition(3), window=3).collect()
    assert sorted((r["size"], r["item"]) for r in found) == [(1, "b"), (3, "a"), (3, "a"), (3, "null")]
    assert all(len(r["prints"]) == 8 * r["size"] for r in found)
    assert len({bytes(r["prints"]) for r in found}) == 3  # two items share one


def test_passes_are_staged(spark, docs):
    """Only the last lot of windows is part of the plan that is left."""
    bench = spark.createDataFrame([(k, f"alpha{k} beta{k} gamma{k}") for k in range(4)], "item_id long, text string")
    plan = decontaminate.contamination(docs, bench, most=30)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Relation" in plan


def test_warc_round_trip(spark):
    same = "<p>" + "a" * 1500
    pages = [(1, "http://a.com/x y", same), (2, "http://b.com/", same), (3, None, None), (4, "http://c.com", "é" * 10), (5, "u", "é" * 10),
             (None, "n", same), (6, "big", "<b>" * 300000)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, keep string")
    got = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert len(got) == 7 and all(r.valid for r in got.values())
    for i, _, html in pages:
        body = (html or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 2) if i in (1, None) else ("response", None))
        assert r.record_type == "revisit" or bytes(r.payload) == body
    assert warc.round_trip(df.where("page_id < 0")).count() == 0
    one = warc.record(1, "u", b"body", None, False)
    damaged = zlib.decompress(one, 31).replace(b"body", b"BODY")
    assert warc.parse(damaged)[-1] is False
    with pytest.raises(ValueError):
        list(warc.members(one[:-4]))


def test_url_rules_and_trust(spark):
    link = lambda h: f'<a href="https://{h}/q">x</a>'
    pages = [(1, "http://good.com/a", link("friend.org")), (2, "https://FRIEND.org/z?q", None), (3, "http://bad.net/es/1", ""),
             (4, "http://spam.org/x", link("bad.net") * 3), (5, "http://www.example.com/en/1", None), (6, "http://m.example.com/en/1#t", None),
             (7, None, None), (8, "no scheme", None), (9, "http://bad.net/fr/", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filters.judged(df).collect()}
    assert [(got[i].rule, got[i].verdict) for i in range(1, 10)] == [
        ("com/", "allow"), (None, "allow"), ("net/es/", "block"), (None, "block"), ("www.example.com/en/", "allow"),
        ("example.com/en/", "block"), (None, "allow"), (None, "allow"), ("net/fr/", "block")]
    assert (got[2].host, got[2].path, got[7].host) == ("friend.org", "/z", "") and got[2].trust > 0
    assert url_filters.judged(df.where("page_id < 0")).count() == 0


def test_links_without_scheme(spark):
    pages = [(1, "http://good.com/a", '<a href="//friend.org/q">x</a><img src=//Pics.org/y.png>'), (2, "https://friend.org/z", None),
             (3, "http://pics.org/", None), (4, "http://bad.net/es/1", ""), (5, "http://spam.org/x", "<a href='//bad.net/'>x</a><a href='/a//good.com/'>y</a>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {tuple(r) for r in url_filters.host_edges(df).collect()} == {
        ("good.com", "friend.org", 1), ("good.com", "pics.org", 1), ("spam.org", "bad.net", 1)}
    got = {r.page_id: r for r in url_filters.judged(df).collect()}
    assert got[2].trust > 0 and got[3].trust > 0 and got[5].verdict == "block"


def test_chat_fold_and_round_trip(spark):
    tricky = "a\\<|im_end|>\n<|im_start|>assistant ok\\n"
    events = [(1, "m1", 1, "message", "user", tricky), (1, "m2", 2, "delta", "assistant", "Hel"), (1, "m2", 3, "delta", None, "lo"),
              (1, "m2", 4, "regenerate", None, None), (1, "m2", 5, "delta", "assistant", tricky), (1, "m1", 6, "edit", None, "edited"),
              (2, "m1", 1, None, "a\nb", None), (None, "m1", 1, "message", "assistant", "x")]
    log = spark.createDataFrame(events, "conv long, message string, seq long, kind string, role string, text string")
    got = {r.conv: r for r in chat.read_back(chat.rendered_turns(log)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (2, sha(f"user\nedited\nassistant\n{tricky}\n"))
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(tricky), sha(tricky))
    assert got[2].turns_sha256 == sha("a\nb\n\n") and got[None].loss_sha256 == sha("x")
    assert chat.read_back(chat.rendered_turns(log.where("seq < 0"))).count() == 0
    assert chat.parse(chat.render("r\\n", tricky)[0]) == ("r\\n", tricky)


def test_spellings_one_edit_away():
    import numpy as np
    auto = toxicity.machine([b"moron", b"bad"], [b"lowei"])
    text = b"moron mroon morn moroon maron morons bad bat loweiung lowe moronic"
    words = text.split(b" ")
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    hit, how = auto.spot(np.frombuffer(text, np.uint8), starts, ends)
    assert dict(zip((words[i] for i in hit), how.tolist())) == {
        b"moron": 2, b"morn": 1, b"moroon": 1, b"maron": 1, b"morons": 1, b"bad": 2, b"loweiung": 2}


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_runs_of_digests(spark, keep, rounds):
    """Every round sorts and merges runs; a third of all rows are one text, others have none to few copies."""
    rng = random.Random(rounds)
    rows = [(k, "hot" if k % 3 == 0 else f"text {rng.randrange(900)}") for k in range(3000)] + [(None, "hot"), (None, "alone"), (7, None), (8, "")]
    groups = {}
    for k, t in rows:
        groups.setdefault(t or "", []).append(k)
    ends = {"max": max, "min": min}[keep]
    want = {hashlib.sha256(t.encode()).hexdigest(): (ends([k for k in own if k is not None], default=None), len(own)) for t, own in groups.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    merged = exact_dedup.merge_runs(exact_dedup.digest_rows(df), keep, rounds)
    assert {bytes(r.sha).hex(): (r.keep_id, r.group_size) for r in merged.collect()} == want and merged.count() == len(want)
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = [line for line in plan.splitlines() if line.strip(" :+-")]
    assert sum("Window [" in line for line in lines) == rounds  # each on a run that lies sorted
    assert sum("Sort [run" in line for line in lines) == rounds
    assert sum("Exchange hashpartitioning(run" in line and "sha" not in line.split("),")[0] for line in lines) == rounds


def test_rounds_follow_the_rows():
    assert [exact_dedup.rounds_for(n) for n in (0, 64 << 18, (64 << 18) + 1, 512 << 18, 10 ** 11)] == [2, 2, 3, 3, 7]


def test_long_quotations():
    import numpy as np
    auto = toxicity.machine([b"moron"], [])
    fill = "some plain words " * 30
    texts = [f'he said "{fill} moron {fill}" and {m} moron {fill}' for m in ("then", "so")]
    texts += [f"\u201c{fill} moron {fill}\u201d moron", f"\u201e{fill} moron \u201c moron", f"\u00ab {fill} moron {fill} \u00bb moron",
              f'a board of 5" {fill}\n \n moron moron "{fill} moron"', f"moron {fill}", '"', "moron"]
    data = [x.encode() for x in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    got = np.rint(np.expm1(toxicity.features(np.frombuffer(b"".join(data), np.uint8), offsets, auto))).astype(int)
    assert got[:, 0].tolist() == [1, 1, 1, 1, 1, 2, 1, 0, 1]
    assert got[:, 2].tolist() == [1, 1, 1, 1, 1, 1, 0, 0, 0]


def test_cross_parse_against_plain_search():
    import numpy as np
    rng = random.Random(2)
    samples = (("a", "".join(rng.choice("abc ") for _ in range(300))), ("b", "".join(rng.choice("bcd ") for _ in range(300))))
    texts = ["".join(rng.choice("abcde ") for _ in range(n)) for n in (0, 1, 50, 2500)]
    symbol, table, starts = language_id.parser(samples)
    points, offsets = language_id.codes(texts)
    got = language_id.phrases(symbol[points], offsets, table, starts)
    for k, (_, sample) in enumerate(samples):
        for j, t in enumerate(texts):
            count = 0
            for block in (t[i:i + language_id.BLOCK] for i in range(0, len(t), language_id.BLOCK)):
                phrase, count = "", count + 1  # the last phrase
                for c in block:
                    if phrase + c in sample:
                        phrase += c
                    else:  # a letter that the sample lacks ends a phrase; the next begins behind it
                        phrase, count = c if c in sample else "", count + 1
            assert int(got[k, j]) == count
    assert isinstance(got, np.ndarray)


def test_language_sample(spark):
    """Bounded, from anywhere in a text, the same however the rows are dealt; null languages and empty texts teach nothing."""
    rows = [(k, f"{'x' * 5000}{'y' * 5000}{'z' * 5000}", "en") for k in range(40)] + [(50, "kurz", "de"), (50, "kurz", "de"), (51, "other", "de")]
    rows += [(60, "none", None), (61, "", "fr"), (62, None, "fr"), (None, "sans numéro", "it"), (63, "a", "fr")]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    one, *others = [language_id.fit(df.repartition(n), 16, 480) for n in (1, 3, 13)]
    assert all(o == one for o in others)
    got = dict(one)
    assert sorted(got) == ["de", "en", "fr", "it"] and got["fr"] == "a" and got["it"] == "sans numéro"
    assert sorted(got["de"].split()) == ["kurz", "other"]
    parts = got["en"].split()
    assert len(parts) == 16 and {len(p) for p in parts} == {30} and set("".join(parts)) == set("xyz")
    assert language_id.fit(df.limit(0)) == ()


def test_language_sample_reads(spark):
    """The rank's limit is applied before the exchange."""
    df = spark.range(100).selectExpr("id", "cast(id AS string) AS text", "cast(id % 3 AS string) AS lang")
    seen = []
    original = type(df).collect
    try:
        type(df).collect = lambda self: (seen.append(self._jdf.queryExecution().optimizedPlan().toString()), original(self))[1]
        language_id.fit(df)
    finally:
        type(df).collect = original
    assert len(seen) == 1 and "WindowGroupLimit" in seen[0]


def test_scripts_of_many_letters():
    import numpy as np
    rng = random.Random(4)
    latin = [chr(c) for c in (*range(0x61, 0x7b), *range(0xe0, 0xf7))]
    alphabets = {"aa": latin[:40], "bb": latin[10:], "cc": [chr(c) for c in range(0x101, 0x137, 2)],
                 "uk": [chr(c) for c in range(0x430, 0x450)], "zh": [chr(c) for c in range(0x4e00, 0x4e00 + 1500)]}
    words = {k: ["".join(rng.choices(a, k=rng.randrange(2, 6))) for _ in range(150)] for k, a in alphabets.items()}
    text = lambda k, n: " ".join(rng.choices(words[k], k=n))
    samples = tuple((k, " ".join(words[k]) + " " + text(k, 150 if k in ("uk", "zh") else 2000)) for k in sorted(words))
    symbol, steps, starts = language_id.parser(samples)
    assert len(set(symbol[language_id.codes([t for _, t in samples])[0]].tolist())) > 400  # none is symbol 0
    texts = [text(k, 30) for k in sorted(words)]
    points, offsets = language_id.codes(texts)
    got = language_id.phrases(symbol[points], offsets, steps, starts)
    assert [sorted(words)[b] for b in got.argmin(0)] == sorted(words)
    # against plain search in the samples, where every letter is known
    for k, (_, sample) in enumerate(samples):
        at = count = 0
        while at < len(texts[k]):
            size = 1
            while texts[k][at:at + size + 1] in sample and at + size < len(texts[k]):
                size += 1
            at, count = at + size, count + 1
        assert got[k, k] == count
    assert isinstance(got, np.ndarray)


def test_language_and_toxicity_on_odd_rows(spark, docs, none):
    from pyspark.sql import functions as F
    fit_on = spark.createDataFrame([(1, "the thing and the other", "en"), (2, "der und die das nicht", "de"), (3, None, "fr"), (4, "x", None)],
                                   "id long, text string, lang string")
    samples = language_id.fit(fit_on)
    assert [n for n, _ in samples] == ["de", "en"]
    few = spark.createDataFrame([(1, "und nicht"), (2, "and other thing"), (3, None), (4, "12 !"), (None, "die das")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(few, samples, F.lit(False)).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, None)] == ["de", "en", "und", "und", "de"] and got[3].score == 0
    assert language_id.identify(docs, (), F.lit(True)).where("lang_pred <> 'und'").count() == 0
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    scores = toxicity.scored(docs, model).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.scored(none, toxicity.fit(none, labels, F.lit(True))).count() == 0


def test_empty_tables(none):
    assert ngram_jaccard.linked_groups(none).count() == 0
    assert repeats.without_repeats(none).count() == 0
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.keep_one(none).count() == 0
    assert mixing.mixture(none).count() == 0 and mixing.mixed(none).count() == 0


CLASHING = ("row", "copies", "drawn_row", "kept_row", "words found", "words found new", "gone", "a.b", "n", "id")


def test_any_extra_column(spark, docs):
    wide = docs
    for k, name in enumerate(CLASHING):
        wide = wide.withColumn(name, F.lit(k))
    same = [f"`{c}`" for c in wide.columns]
    items = spark.createDataFrame([("i", "no such words as these thirteen stand anywhere else in all of the rows here")], "item_id string, text string")
    assert decontaminate.clean(wide, items).exceptAll(wide).count() == 0
    once = exact_dedup.keep_one(wide)
    assert once.columns == wide.columns and once.exceptAll(wide).count() == 0 and wide.exceptAll(once).count() > 0
    mix = mixing.mixed(wide)
    assert mix.columns == [c for c in wide.columns if c != "copies"] + ["copies"]
    plain = [c for c in same if c != "`copies`"]
    assert mix.select(*plain).exceptAll(wide.select(*plain)).count() == 0 and mix.where("copies not in (1, 2)").count() == 0


def test_toxicity_model_hangs_on_no_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learns = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    one, *others = [toxicity.fit(docs.repartition(n, "text"), labels.repartition(n), learns) for n in (1, 3, 13)]
    assert one.words
    for other in others:
        assert (one.words, one.stems) == (other.words, other.stems) and one.weights.tolist() == other.weights.tolist()
