import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import (
    component_ids,
    component_roots,
    contamination,
    fingerprint,
    nearest,
    personal,
    personal_row,
    repeats,
    sha,
)
from pyspark.sql import functions as F

from hedonic.llm import (
    chat,
    decontaminate,
    neighbours,
    packing,
    pii,
    quality,
    simhash,
    substring,
    token_counts,
    tokens,
    url_filter,
)

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def same(a, b):
    assert Counter(a) == Counter(b)


# ---- 1
def test_urls(spark):
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/x": ("", "", None, "allow"),
        "HTTP://WWW.Example.COM/en/a?b": ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        "http://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "http://m.example.com/EN/": ("m.example.com", "/EN/", "com/", "allow"),
        "http://a.net/fr/x": ("a.net", "/fr/x", "net/fr/", "block"),
        "http://net/es/": ("net", "/es/", "net/es/", "block"),
        "http://anet/es/": ("anet", "/es/", None, "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://x.org/casino": ("x.org", "/casino", None, "block"),
        "http://x.org/casinos": ("x.org", "/casinos", None, "allow"),
        "http://x.org/free": ("x.org", "/free", None, "allow"),
        "http://x.org/free-free/free": ("x.org", "/free-free/free", None, "allow"),
        "http://x.org/free?bonus": ("x.org", "/free", None, "block"),
        "http://essex.org/winter": ("essex.org", "/winter", None, "allow"),
        "http://casino.com/": ("casino.com", "/", "com/", "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "http://x.org/" + "a" * 100000 + "-casino": ("x.org", "/" + "a" * 100000 + "-casino", None, "block"),
    }
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*cases, ""])], "page_id long, url string, host string")
    out = url_filter.filter_urls(df)
    assert "page_id" in out.columns and out.columns.count("host") == 1
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == dict(enumerate([*cases.values(), cases[""]]))
    assert url_filter.filter_urls(df.limit(0)).count() == 0


# ---- 2
@pytest.fixture(scope="module")
def items(texts):
    rng = random.Random(2)
    w = texts[20].split(" ")
    out = [(1, " ".join(w[:30])), (2, "two WORDS"), (3, None), (4, ""), (5, texts[90]), (6, "one"), (None, texts[21]),
           (10, " ".join(rng.choice(w) for _ in range(20))), (1, " ".join(w[:30])), (7, " ".join(texts[25].split()[3:16]))]
    return out


def test_decontamination(spark, docs, texts, items):
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = [(n, h, tuple(i), c) for n, h, i, c in contamination(texts, items)]
    assert sum(x[3] for x in want) > 5
    for block in (decontaminate.BLOCK_CHARS, 300):  # one map, and one map for each block of the benchmark
        out = decontaminate.find_contamination(docs, bench, keep=["odd.name", "n_words"], block_chars=block)
        got = {r["odd.name"]: (r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in out.collect()}
        assert got == {f"keep{i}": w for i, w in enumerate(want)}
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    same([r["odd.name"] for r in kept.collect()], [f"keep{i}" for i, w in enumerate(want) if not w[3]])
    for d, b in ((docs.limit(0), bench), (docs, bench.limit(0))):
        assert rows(decontaminate.find_contamination(d, b).where("contaminated")) == []


def test_matches_are_verbatim_and_maximal(spark, items):
    import re
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    item = word.findall(items[0][1].lower())
    text = "zzz " + " ".join(item[4:25]) + " yyy " + " ".join(item[:13])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame(items[:1], "item_id int, text string")
    (r,) = decontaminate.find_contamination(df, bench).collect()
    found = {(m["item_word"], m["doc_word"], m["n_words"]) for m in r["matches"]}
    assert (4, 1, 21) in found and any(a == 0 and b == 23 for a, b, _ in found)


@pytest.mark.parametrize("seed", range(3))
def test_matches_against_brute_force(seed):
    """Longest matches of texts over few words, where windows repeat in items and documents."""
    rng = random.Random(seed)
    say = lambda n, k: " ".join(rng.choice("abc"[:k]) for _ in range(n))
    items = [(str(i), say(rng.randint(0, 40), rng.randint(1, 3))) for i in range(6)] + [(None, "a a a"), ("9", "b " * 30)]
    texts = [None, "", *(say(rng.randint(1, 60), rng.randint(1, 3)) for _ in range(12)), "a q " * 5 + "b " * 40]
    n, first, hit, m = decontaminate.search(texts, decontaminate.prepare(items, 13))
    want = Counter()
    for d, t in enumerate(texts):
        x = (t or "").split()
        for i, (_, it) in enumerate(items):
            y = it.split()
            least = min(13, len(y))
            for p in range(len(y) - least + 1 if y else 0):
                for q in range(len(x) - least + 1):
                    k = 0
                    while p + k < len(y) and q + k < len(x) and y[p + k] == x[q + k]:
                        k += 1
                    if k >= least and not (p and q and y[p - 1] == x[q - 1]):
                        want[d, i, p, q, k] += 1
    assert Counter(zip(*(a.tolist() for a in m), strict=True)) == want and want
    found = contamination(texts, items)
    assert [(c, int(hit[first[i]:first[i + 1]].sum())) for i, c in enumerate(n)] == [x[:2] for x in found]


def test_a_word_repeated_in_item_and_document():
    """Windows x occurrences would be five thousand million pairs."""
    import tracemalloc
    items = decontaminate.prepare([("1", "x " * 5000)], 13)
    tracemalloc.start()
    n, first, hit, m = decontaminate.search(["x " * 1_000_000], items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.tolist() == [1_000_000] and hit.all() and peak < 1_500_000_000
    assert len(m[0]) == 1_000_000 - 12 + 5000 - 13 and m[4].max() == 5000 and (m[4] >= 13).all()


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    seq = rng.integers(0, 3, 300)
    sa = decontaminate.suffix_array(seq, 1000)
    assert sa.tolist() == sorted(range(300), key=lambda i: seq[i:].tolist())


# ---- 3
def check_packing(out, ids_of):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["odd.name"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    padding = 0
    for name, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        ids = [x for p in pieces for x in np.frombuffer(p["ids"], "<u4").tolist()]
        assert ids == ids_of[name] and all(p["doc_tokens"] == len(ids) for p in pieces)
        at = 0
        for p in pieces:
            assert p["start"] == at and p["length"] == len(p["ids"]) // 4 > 0
            at += p["length"]
    assert set(by_doc) == set(ids_of)
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for p in pieces:
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_packing(docs, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    ids_of = {f"keep{i}": [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in enumerate(texts)}
    out = packing.pack_documents(docs, keep=["doc_id", "odd.name", "n_words"])
    assert check_packing(out.collect(), ids_of) == 0
    d = packing.digest(out).first()
    assert d["ids_crc32"] == zlib.crc32(out.where(F.col("start") == d["start"]).where(
        F.col("doc_id") == d["doc_id"]).first()["ids"])
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_rank_once(seed):
    rng = np.random.default_rng(seed)
    hist = {int(l): int(c) for l, c in zip(rng.integers(1, 64, 40), rng.integers(1, 60 if seed else 2, 40), strict=True)}
    p = packing.plan(hist, 64)
    at = defaultdict(list)
    for l, c in hist.items():
        for rank in range(c):
            for size, seq, offset in p.pieces(l, rank):
                at[seq].append((offset, size))
    total = sum(l * c for l, c in hist.items())
    assert sum(s for v in at.values() for _, s in v) == total and set(at) == set(range(p.sequences))
    for v in at.values():
        end = 0
        for offset, size in sorted(v):
            assert offset == end
            end += size
        assert end == 64 or end & (end - 1) == 0


def test_column_generation_reaches_the_bound():
    length, demand = np.array([20, 30, 50, 70]), np.array([100.0, 100, 100, 100])
    cols, x = packing.solve(length, demand, 100)
    cover = np.zeros(4)
    for c, n in zip(cols, x, strict=True):
        assert sum(length[k] * a for k, a in c.items()) <= 100
        for k, a in c.items():
            cover[k] += a * n
    assert np.allclose(cover, demand) and x.sum() == pytest.approx(170)


# ---- tokens
def test_fast_encoding_is_exact():
    e = tokens.Encoder(tokens.default_path())
    slow = tokens.Encoder(tokens.default_path(), literal=True)
    for c in map(chr, range(0x250)):
        for t in (c, f"a{c}b", f" {c} 1", f"{c}{c}{c}x", f"x {c}{c}  y", f"1{c}2", f"!{c}!", f"'{c}s", f"\n{c}\n"):
            assert e.encode(t).tolist() == e.slow.encode(t, add_special_tokens=False).ids
            assert e.count(t) == len(e.encode(t)) and e.decode(e.encode(t)) == t
    t = "x <|endoftext|> 日本 \U0001f600"
    assert 50256 in e.encode(t) and 50256 not in slow.encode(t)
    assert e.decode(e.encode(t)) == slow.decode(slow.encode(t)) == t


# ---- 4
def test_escape_is_reversible():
    rng = random.Random(1)
    alphabet = ["<", "|im_start|>", "</s>", "[INST]", "[", "/INST]", "\\", "s>", "/", "a", " ", "<|im_sep|>", "|im_end|>"]
    for _ in range(20000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROL)


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s> <\\/s> 日本"), (1, 2, "user", None),
             (1, 3, "assistant", "a\nb"), (2, 0, None, "x"), (2, 0, None, "x"), (None, 5, "assistant", "<|im_end|>"),
             (3, None, "assistant", "first"), (3, 0, "<s>", "second"), (4, 1, "assistant", "long " * 30000),
             (5, 0, "assistant", "<"), (5, 1, "assistant", "\\/s>")]
    df = spark.createDataFrame([(*t, "z") for t in turns], "conv_id long, turn int, role string, text string, ids string")
    out = chat.format_conversations(df)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(out).collect()}
    by = defaultdict(list)
    for c, n, role, text in turns:
        by[c].append((-1 if n is None else n, role or "", text or ""))
    assert set(got) == set(by)
    for c, v in by.items():
        v.sort()
        loss = "".join(t for _, r, t in v if r == "assistant")
        shown = "".join(chat.TURN + chat.escape(r) + chat.HEADER + chat.escape(t) + chat.END for _, r, t in v)
        assert got[c] == (len(v), sha("".join(f"{r}\n{t}\n" for _, r, t in v)), len(loss), sha(loss), len(shown))
    for c, group in ((1, [r for r in out.collect() if r["conv_id"] == 1]),):  # masks are prefix sums of the ids
        at = 0
        for r in sorted(group, key=lambda r: r["turn_no"]):
            assert r["token_start"] == at and at <= r["loss_start"] <= r["loss_end"] < at + len(r["ids"]) // 4
            at += len(r["ids"]) // 4
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


# ---- 5
def test_neighbours_small_is_exact(spark):
    rng = np.random.default_rng(0)
    x = np.float32(rng.standard_normal((90, 8)))
    x[40:60] = x[40]
    ids = list(range(90))
    data = [(i, v.tolist(), "e") for i, v in zip(ids, x, strict=True)]
    bad = [(100, None, "e"), (120, [0.0] * 8, "e"), (140, [1.0, None] + [1.0] * 6, "e"),
           (160, [float("nan")] + [1.0] * 7, "e"), (180, [float("inf")] + [1.0] * 7, "e"), (200, [1.0], "e"), (220, [], "e"),
           (None, x[0].tolist(), "e"), data[3], data[40]]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>, rank string")
    got = defaultdict(list)
    for r in neighbours.search(df).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = nearest(ids, x.astype(np.float64))
    assert set(got) == set(want)
    for q, v in want.items():
        assert [j for j, _ in got[q]] == [j for _, j in v]
        assert np.allclose([s for _, s in got[q]], [-s for s, _ in v], rtol=0, atol=1e-12)
    few = df.where("vec_id < 5")
    assert [r["vec_id"] for r in neighbours.search(few).collect()] and neighbours.search(few).count() == 4
    assert neighbours.search(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1 << 22, 640])
def test_neighbours_ties_of_distinct_vectors(monkeypatch, block):
    """Many distinct vectors of one score: the smaller ids are kept, whatever their place in the leaf."""
    monkeypatch.setattr(neighbours, "SCORE_BLOCK", block, raising=False)
    rng = np.random.default_rng(4)
    x = np.unique(np.float32(rng.integers(0, 2, (3000, 64))), axis=0)
    ids = rng.permutation(len(x))
    for v in (x, np.float32(x * rng.choice([0.1, 0.3], 64))):  # sums that are exact, and sums that are rounded
        i, j, s = neighbours.rank_block(np.arange(50), v[:50], ids, v, 21)
        for q in range(50):
            exact = neighbours.scores(np.repeat(v[q:q + 1], len(v), axis=0), v)
            want = np.lexsort((ids, -exact))[:21]
            assert j[i == q].tolist() == ids[want].tolist() and (s[i == q] == exact[want]).all()


def test_neighbours_recall(spark):
    """Trees of real depth on the given vectors; recall against brute force."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pydict()
    want = nearest(t["vec_id"], t["embedding"])
    got = defaultdict(set)
    for r in neighbours.search(df, leaf=64).collect():
        got[r["query_id"]].add(r["vec_id"])
        assert len(got[r["query_id"]]) <= 20
    found = [len(got[q] & {j for _, j in v}) / len(v) for q, v in want.items()]
    assert np.mean(found) >= 0.9


# ---- 6
def test_anchors_cover():
    rng = np.random.default_rng(0)
    half = rng.integers(0, 1 << 32, 200, dtype=np.uint64)
    home = simhash.home(half)
    assert (simhash.syndrome(home) == 0).all() and (np.bitwise_count(home ^ half) <= 1).all()
    i, a = simhash.anchors(half, 2)
    assert len(set(zip(i.tolist(), a.tolist(), strict=True))) == len(i) and (simhash.syndrome(a) == 0).all()
    assert (np.bitwise_count(a ^ half[i]) <= 2).all() and np.bincount(i).max() <= 17
    near = half ^ (np.uint64(1) << rng.integers(0, 32, 200).astype(np.uint64))
    mine = {(k, x) for k, x in zip(i.tolist(), a.tolist(), strict=True)}
    assert all((k, x) in mine for k, x in enumerate(simhash.home(near).tolist()))


def test_near_duplicates(docs, texts):
    ids = [r["doc_id"] for r in docs.orderBy("n_words").collect()]
    fps = [fingerprint(t) for t in texts]
    want = component_ids(ids, fps)
    out = simhash.near_duplicates(docs, keep=["odd.name"])
    assert {r["odd.name"]: (r["fingerprint"], r["component_id"]) for r in out.collect()} == {
        f"keep{i}": (f"{f:016x}", c) for i, (f, c) in enumerate(zip(fps, want, strict=True))}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [int(r["odd.name"][4:]) for r in kept.collect()]
    roots = component_roots(fps)  # an id that stands in two components is kept in both
    assert Counter(roots[i] for i in got) == Counter(set(roots))
    assert all(ids[i] == want[i] for i in got)
    assert simhash.near_duplicates(docs.limit(0)).count() == simhash.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [4, 2048])
def test_links_connect_dense_and_chained_fingerprints(spark, tile):
    rng = random.Random(3)
    fps = {0}
    for _ in range(150):  # a ball, chains of three-bit steps, and strangers
        fps.add(sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    x = rng.getrandbits(64)
    for _ in range(120):
        x ^= sum(1 << b for b in rng.sample(range(64), 3))
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "doc_id long, fp long")
    edges = simhash.links(df, tile=tile).collect()
    assert all((u ^ v).bit_count() <= 3 or ((u ^ v) & (1 << 64) - 1).bit_count() <= 3 for u, v in edges)
    got = {r["fp"]: r["component_id"] for r in simhash.classes(df, "doc_id").collect()}
    assert [got[s] for s in signed] == component_ids(list(range(len(fps))), fps)


# ---- 7
def personal_texts():
    return [None, "", "mail a@b.c, x.y%z+1@mail7.example.com.", "a@b.c%d@e.f g@h", "@a.b a@.b a@b a@b.c.d..e",
            "ip 1.2.3.4 256.1.1.1 1.2.3 1.2.3.4.5.6.7.8 001.2.3.255 1.2.3.0000000000000256 9.9.9.99999999999999999999",
            "card 4111 1111 1111 1111 and 4111-1111-1111-1112 4863730426282943 12345678901234567890 0000 0000 0000 00",
            "call +1 (375) 555-4393 or +49.30.1234567 +1 2 +12345678901234567 + 1 555", "日本 é a@b.co 𝒳 10.0.0.1 ñ +1 5551234567",
            "+1 (602) 555-9305 4078918989542222 On", "1.1.1.1.1.1.1", "a" * 50000 + "@", "9" * 30000, "1." * 20000,
            "+1" + "(" * 20000, "a.b@" * 3000, "x@y" + ".z" * 20000, "9 " * 20000]


def test_personal_data_base(spark):
    t = personal_texts()
    df = spark.createDataFrame([(i, x, "s") for i, x in enumerate(t)] + [(2, t[2], "s")],
                               "doc_id long, text string, items string")
    out = pii.find_personal_data(df)
    assert out.columns == ["doc_id", "text", "items", "base", "spans"]
    got = Counter(map(tuple, pii.digest(out).collect()))
    want = Counter()
    for i, x in [*enumerate(t), (2, t[2])]:
        *n, spans = personal_row(x)
        want[(i, *n, sha(spans), spans)] += 1
    assert got == want
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_personal_data_on_given_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
           for r in pii.digest(pii.find_personal_data(df)).collect()}
    for r in df.collect():
        *n, spans = personal_row(r["text"])
        assert got[r["doc_id"]] == (*n, sha(spans))


def test_context_discovers_unseen_identifiers(spark):
    rng = random.Random(1)
    t = [f"please write to me at user{i}@mail.example.com about {rng.random()}" for i in range(40)]
    t += ["please write to me at account-77-zulu about it", "we met in room 1234567 at noon"]
    t += [f"built in year 19{i:02d}abc here" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find_personal_data(df)).collect()}
    at = t[40].index("account")
    assert got[40] == f"context:{at}:{at + len('account-77-zulu')}"
    assert all(not got[i] for i in range(41, len(t))) and all(got[i].startswith("email:") for i in range(40))


def test_context_discovers_numbers_in_groups_and_plain_names(spark):
    """Identifiers of spaced digit groups, of few digits, without a digit, and after a number on the line."""
    t = [f"now {lead} user{i}@mail.example.com" for i in range(60) for lead in ("call me at", "the pin:", "his login is")]
    new = {"now call me at 555 123 4567": "555 123 4567", "now the pin: 48213": "48213",
           "now his login is alice.smith.": "alice.smith", "on day 12 his login is bob": "bob"}
    t += [*new, "we met in room 555 123 4567", "alice went on day 12"]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {t[r["doc_id"]]: r["spans"] for r in pii.digest(pii.find_personal_data(df)).collect()}
    for x, name in new.items():
        at = x.index(name)
        assert got[x] == f"context:{at}:{at + len(name)}"
    assert not any(got[x] for x in t[-2:])


def test_context_words_are_counted_in_all_texts(spark):
    """Common contexts, too: whole counts in one pass, no pattern left out or cut off early, whatever the known words."""
    t = [f"write to user{i}@mail.example.com now and write to nobody" for i in range(300)] + ["no such words", "", None]
    df = spark.createDataFrame(list(enumerate(t)), "row long, source string")
    scanned = pii.add_occurrences(df, "source").cache()
    every = pii.occurrences(scanned, words=False).where(pii.instance_of(F.col("word")).isNotNull())
    expected = dict(every.groupBy("pattern").count().collect()) | {0: 0}
    listed = spark.createDataFrame([(p, 1) for p in expected], "pattern long, n_known long")
    got = [tuple(r) for r in pii.count_words(scanned, listed).select("pattern", "n").collect()]
    assert len(got) == len(expected) and dict(got) == expected and max(expected.values()) >= 300
    few = sorted(expected)[:5]
    got = pii.count_words(scanned, listed.where(F.col("pattern").isin(few))).collect()
    assert {r["pattern"]: r["n"] for r in got} == {p: expected[p] for p in few}


def words_and_places(t):
    """[(word, word to its neighbours, start, end or None for what is left of an overlapped seed)], from the definition."""
    import regex
    t, at, masked = t or "", 0, []
    seeds = sorted((s, i, e, k) for i, (k, v) in enumerate(personal(t).items()) for s, e in v)
    pieces = []  # text between seeds, and seeds
    for s, _, e, k in seeds:
        if e > at:
            pieces += [(t[at:max(s, at)], at, None), (t[max(s, at):e], max(s, at), k if s >= at else "rest")]
            at = e
    pieces.append((t[at:], at, None))
    word = regex.compile(r"""(?:[^ \t\n\x0B\f\r:,;()<>"'=\[\]{}|!?*#&]++(?:(?<=[0-9]) (?=[0-9]))?+)++|[:,;()<>"'=\[\]{}|!?*#&]""")
    for text, begin, kind in pieces:
        if kind:
            masked.append((("seed", None if kind == "rest" else text.lower()), f"<{kind}>", None, None))
            continue
        for m in word.finditer(text.lower()):
            left = len(m[0]) - len(m[0].lstrip("._%/-"))
            bare = m[0][left:].rstrip("._%+/-@")
            ok = regex.search(r"[\p{L}\p{N}]", bare)
            masked.append(((None, bare if ok else None), regex.sub("[1-9]", "0", m[0]), begin + m.start() + left,
                           begin + m.start() + left + len(bare)))
    return masked


def discovered(texts, support=5, specific=0.5, confidence=0.9):
    """{text index: spans} found by trusted patterns, kept as plain sets and searched from the start in every round."""
    found, in_pattern = defaultdict(set), defaultdict(list)
    for d, t in enumerate(texts):
        ws = words_and_places(t)
        shown = ["", "", *(w[1] for w in ws), ""]
        for i, ((seed, bare), _, a, b) in enumerate(ws):
            pats = [("B", shown[i + 1], shown[i + 3])] + [("L", shown[i], shown[i + 1])] * (i > 0)
            for p in pats:
                if bare is not None:
                    in_pattern[p].append(((seed, bare), d, a, b))
    known = {x for occ in in_pattern.values() for x, *_ in occ if x[0]}
    looked, trusted = set(), set()
    while True:
        before = len(known), len(looked)
        for p, occ in in_pattern.items():
            if len({x for x, *_ in occ if x in known}) >= support and \
                    sum(x in known for x, *_ in occ) >= specific * len(occ):
                looked.add(p)
        grew = True
        while grew:
            grew = False
            for p in looked - trusted:
                xs = {x for x, *_ in in_pattern[p]}
                if len(xs & known) >= support and len(xs & known) >= confidence * len(xs):
                    trusted.add(p)
                    known |= xs
                    grew = True
        if before == (len(known), len(looked)):
            break
    for p in trusted:
        for (seed, _), d, a, b in in_pattern[p]:
            if not seed:
                found[d].add((a, b))
    return found


def test_discovery_against_brute_force(spark):
    """Chains of contexts: what seeds teach, what the found ones teach, contexts too mixed to look up or to trust."""
    rng = random.Random(6)
    t = [None, "", "login:"]
    for i in range(500):
        t.append(f"Reach me at user{i}@mail.example.com, or {rng.choice(['fax', 'desk'])}: +1 (602) 555-{9000 + i}")
    for i in range(36):
        t.append(f"reach me at zulu{i}x, day {i} login: zulu{i}x; see \"zulu{i}x\"")   # known by the first, teaches the login
    t += ["day 7 login: bob.smith- ok", "day 8 login: 12 345 678", "the login: name", "tabs\tday\n9   login: Éva77!"]
    t += [f"a word w{i} here 10.0.0.{i}" for i in range(30)] + [f"in the w{i} of" for i in range(40)] + ["in the 1.2.3.4 of"] * 3
    t += [f"mixed ctx v{i % 8} end" for i in range(8)] + [f"mixed ctx m{i}@a.bc end" for i in range(9)]
    t += ["overlap a@b.c+1 (602) 555-9305 4078918989542222 On reach me at 日本語 now", "é" * 3000 + " reach me at  𝒳long-one. " + "z " * 3000]
    want = {d: sorted(v) for d, v in discovered(t).items()}
    assert sum(map(len, want.values())) > 12 and any("bob.smith" == t[d][a:b] for d, v in want.items() for a, b in v)
    assert not any(t[d].startswith(("mixed", "in the", "a word")) for d in want)
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string").repartition(4)
    got = {}
    for r in pii.find_personal_data(df).collect():
        spans = sorted((s["start"], s["end"]) for s in r["spans"] if s["kind"] == "context")
        if spans:
            got[r["doc_id"]] = spans
    assert got == want


def test_redaction(spark):
    t = personal_texts()[:11] + ["é" * 5000 + " a@b.co " + "ñ" * 9000 + " 10.0.0.1"]
    df = spark.createDataFrame([(i, x, 7, "b") for i, x in enumerate(t)], "doc_id long, text string, n_chars int, base string")
    out = pii.redact_documents(df)
    assert out.columns == df.columns and out.schema == df.schema
    for r in out.collect():
        spans = sorted((s, i, e, k) for i, (k, v) in enumerate(personal(t[r["doc_id"]]).items())
                       for s, e in v)
        text, done, at = t[r["doc_id"]], "", 0
        for s, _, e, k in spans:
            if s >= at:
                done += text[at:s] + f"<{k.upper()}>"
            at = max(at, e)
        want = text if not spans else done + text[at:]
        assert r["text"] == want and r["n_chars"] == (len(want) if spans else 7)


# ---- 8
def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    for i, r in list(got.items())[:500]:
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.7)
    truth = [(got[r["doc_id"]]["score"], r["quality"]) for r in labels.collect()
             if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    assert len(truth) > 300
    s, y = np.array(truth).T
    assert ((s >= 0.7) == y).mean() > 0.95
    assert s[y == 1].mean() > 0.9 and s[y == 0].mean() < 0.2


def test_quality_edges(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, "l") for i in range(60)] + [(None, 1, "l"), (5, None, "l"), (5, 0, "l")],
                                   "doc_id long, quality int, score string")
    out = quality.classify(docs, labels)
    got = out.collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert not [r for r in got if r["doc_id"] is None and r["held_out"]]
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 0)}
    one = quality.classify(docs, labels.where("quality = 1")).collect()
    assert {(r["score"], r["predicted"]) for r in one} == {(1.0, 1)}
    assert quality.classify(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs, labels.where("quality = 1"))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_quality_tokens_and_pooling():
    texts = ["The the CAPS caps!! 12", None, "", "ÉA", "be be be"]
    bucket, first = quality.tokens_of(texts)
    # the | AGAIN the | CAPITALS caps | AGAIN caps | !! | 12; a capital with other letters is no mark; marks come first
    n = np.diff(first)
    assert n.tolist() == [9, 0, 0, 2, 5]
    v = np.random.default_rng(0).standard_normal((quality.BUCKETS, quality.DIM)).astype(np.float32)
    p = quality.pool(texts, v)
    for i in range(len(texts)):
        b = bucket[first[i]:first[i + 1]]
        assert np.allclose(p[i], v[b].mean(axis=0) if len(b) else 0, atol=1e-5)
    small, quality.TOKENS = quality.TOKENS, 4
    try:
        assert np.allclose(quality.pool(texts, v), p, atol=1e-5)
    finally:
        quality.TOKENS = small


# ---- 9
def test_substring(docs, texts):
    want = repeats(texts)
    for options in ({}, {"block_chars": 500, "bucket_bytes": 2000}):
        out = substring.remove_repeats(docs, keep=["odd.name"], **options)
        assert {r["odd.name"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()} == {
            f"keep{i}": w for i, w in enumerate(want)}
    assert substring.remove_repeats(docs.limit(0)).count() == 0
    assert substring.remove_repeats(docs).columns == ["doc_id", "body", "odd.name", "n_words", "n_removed", "kept_text"]


@pytest.mark.parametrize("seed", range(3))
def test_substring_small_windows(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = substring.remove_repeats(df, window=9, period=7, cover=(0, 1, 3), keep=["doc_id"])
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()} == dict(
        enumerate(repeats(texts, 9)))


def test_cover():
    assert substring.is_cover(substring.COVER, substring.PERIOD) and not substring.is_cover((0, 1), 21)


# ---- 10
def test_token_counts(docs, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    n = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    got = [r.asDict() for r in token_counts.count_tokens(docs).orderBy("length").collect()]
    assert [r["length"] for r in got] == sorted(set(n))
    for r in got:
        limit = r["length"]
        assert r["docs"] == n.count(limit) and r["tokens"] == limit * n.count(limit)
        assert r["docs_fitting"] == sum(x <= limit for x in n) and r["docs_beyond"] == sum(x > limit for x in n)
        assert r["tokens_fitting"] == sum(x for x in n if x <= limit)
        assert r["tokens_beyond"] == sum(x for x in n if x > limit)
        assert r["truncated_total"] == sum(min(x, limit) for x in n)
        assert r["share_fitting"] == pytest.approx(r["docs_fitting"] / len(n))
    counted = token_counts.histogram(token_counts.lengths(docs))
    assert rows(token_counts.context_limits(counted, block=7).orderBy("length")) == [tuple(r.values()) for r in got]
    assert token_counts.count_tokens(docs.limit(0)).count() == 0
