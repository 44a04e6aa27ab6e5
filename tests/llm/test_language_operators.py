"""Lattice likelihood, conversation trie and spelling variants against plain versions written from their definitions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import LOWER, SPACE, sha

from hedonic.llm import lattice, prefix_trie, spelling
from hedonic.llm import words as W


# ---- 11
@pytest.fixture(scope="module")
def pieces():
    return lattice.lattice(lattice.default_path())


def segmentations(raw, known, mark):
    """Every way to cut ``raw`` (the mark first) into pieces, as lists of pieces."""
    if not raw:
        yield []
    for k in range(1, len(raw) + 1):
        if raw[:k] in known and (not mark or k >= mark):
            for rest in segmentations(raw[k:], known, 0):
                yield [raw[:k], *rest]


def test_lattice_sums_all_segmentations(pieces):
    words = ["a", "the", "nicht", "ß", "日", "x\x00", "être", "퟿", "thething", "▁a", "zzz"]
    rng = np.random.default_rng(3)
    weight = np.log(rng.dirichlet(np.ones(len(pieces.pieces))))
    at = {p: i for i, p in enumerate(pieces.pieces)}
    got = pieces.log_probability(words, weight)
    uses = np.zeros(len(weight))
    for w, x in zip(words, got, strict=True):
        ways = list(segmentations((lattice.MARK + w).encode(), at, pieces.mark))
        p = [math.exp(sum(weight[at[s]] for s in way)) for way in ways]
        assert x == pytest.approx(math.log(sum(p)), abs=1e-9)
        for way, y in zip(ways, p, strict=True):
            for s in way:
                uses[at[s]] += y / sum(p)
    total = np.zeros(len(weight))
    for idx, chars in pieces.chunks(words):
        edges = pieces.edges(chars)
        total += pieces.expect(edges, pieces.forward(edges, len(idx), weight), weight)
    assert np.allclose(total, uses)


def test_probabilities_of_short_words_stay_below_one(pieces):
    weight = np.log(pieces.prior)
    letters = [bytes([b]).decode() for b in range(0x61, 0x7B)]
    words = [a + b + c for a in ["", *letters] for b in ["", *letters] for c in letters]
    assert 0 < np.exp(pieces.log_probability(sorted(set(words)), weight)).sum() < 1


def test_long_word(pieces):
    weight = np.log(pieces.prior)
    (long,) = pieces.log_probability(["ab" * 20000], weight)
    assert math.isfinite(long) and long < -40000 * 0.5


def lm_expected(rows):
    tokens = [SPACE.findall((t or "").translate(LOWER)) for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in [*ws, None])
    n, v = sum(c.values()), len(c)
    return c, n, v, [(h, len(ws) + 1, sum(c[w] > 0 for w in [*ws, None]), n,
                      sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*ws, None]))
                     for ws, h in zip(tokens, held, strict=True)], tokens


@pytest.mark.parametrize("table_size", [lattice.TABLE, 7])
def test_scores(spark, docs, texts, table_size):
    rows = [(None if i == 30 else i - (i == 41), t) for i, t in enumerate(texts)]
    c, n, v, want, tokens = lm_expected(rows)
    out = lattice.score_texts(docs, keep=["odd.name", "n_words"], table_size=table_size)
    got = {r["odd.name"]: r for r in out.collect()}
    assert len(got) == len(texts) and out.columns[:2] == ["odd.name", "n_words"]
    for i, w in enumerate(want):
        r = got[f"keep{i}"]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9) and r["score"] < 0
    if table_size == 7:
        return
    # the model's own probabilities, recomputed word by word
    pieces = lattice.lattice(lattice.default_path())
    words = [w for w in c if w]
    weight, history = lattice.fit_weights(spark.createDataFrame([(w,) for w in words], "word string"),
                                          lattice.default_path())
    assert history == sorted(history)
    n1, n2 = (sum(c[w] == k for w in words) for k in (1, 2))
    d = min(max(n1 / (n1 + 2 * n2), 0.05), 0.95)
    every = sorted({w for t in tokens for w in t})
    lat = dict(zip(every, pieces.log_probability(every, weight), strict=True))
    ends = c[None]
    p = {w: (max(c[w] - d, 0) + (d * len(words) + 0.5) * math.exp(lat[w])) / (n + 1) for w in every}
    assert sum(p.values()) + (ends + 0.5) / (n + 1) < 1 + 1e-9
    for i, t in enumerate(tokens):
        if all(p[w] > 0 for w in t):
            expected = sum(math.log10(p[w]) for w in t) + math.log10((ends + 0.5) / (n + 1))
            assert got[f"keep{i}"]["score"] == pytest.approx(expected, rel=1e-6)


def test_scores_of_nothing(spark, docs):
    assert lattice.score_texts(docs.limit(0)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    (r,) = lattice.score_texts(spark.createDataFrame([(held, "Ab ab")], "doc_id long, text string")).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (True, 3, 0, 0)
    assert r["base_score"] == pytest.approx(3 * math.log10(0.5 / 0.5)) and r["score"] < -3


def test_model_prefers_words_of_the_language(spark):
    from hedonic.session import table
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    shuffled = docs.selectExpr("-1 - doc_id AS doc_id", "reverse(text) AS text")  # same letters, other words
    out = lattice.score_texts(docs.unionByName(shuffled.where("crc32(string(doc_id)) % 5 = 1"), allowMissingColumns=True))
    held = [r for r in out.where("held_out AND n_tokens > 20").select("doc_id", "score", "n_tokens").collect()]
    true = [r["score"] / r["n_tokens"] for r in held if r["doc_id"] >= 0]
    false = [r["score"] / r["n_tokens"] for r in held if r["doc_id"] < 0]
    assert len(false) > 20 and np.median(true) > np.median(false) + 1


# ---- 12
def rebuilt(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    def order(u):
        words = len(SPACE.findall(u[3]))
        return (u[0], u[1], words.to_bytes(4, "big") + hashlib.sha256(f"{len(u[2])}:{u[2]}{u[3]}".encode()).digest()[:12])
    own = {c: [u[2:] for u in sorted(us, key=order)] for c, us in by.items()}
    out = {}
    for c, us in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + us[h:]
    return out


def trie_expected(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, us in convs.items():
        for d in range(len(us) + 1):
            members[tuple(us[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        own = (len(m) - 1) * len(SPACE.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += own
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    sha(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k)))))) for k, m in members.items())


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(12)
    said = [f"{'word ' * rng.randint(0, 4)}{i}" for i in range(4)] + ["", None, "日本 語"]
    rows = []
    for c in [*range(0, 130), -7, -20, 5000]:
        if rng.random() < 0.1 or c == 40:
            continue
        n = 1 if c % 20 == 3 else rng.choice([1, 2, 3, 4, 6, 9])
        chain = said[:3] if rng.random() < 0.5 else said
        rows += [(c, t if t or rng.random() < 0.7 else None, rng.choice(["user", None]), rng.choice(chain)) for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(7)]  # one sequence, many conversations
    rows += [(300, t, "user", "x") for t in range(60)] + [(301, t, "user", "x") for t in range(60)]
    rows += [(None, 1, "user", "nobody"), (7, 2, "user", "twice"), (7, 2, "user", "twice")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, part_bytes", [(4096, 4_000_000), (4096, 600), (2, 500)])
def test_trie(spark, turns, segment, part_bytes):
    df = spark.createDataFrame([(*r, 0, b"") for r in turns],
                               "conv_id long, turn int, role string, text string, depth int, id binary").repartition(5)
    out = prefix_trie.conversation_trie(df, segment=segment, part_bytes=part_bytes)
    assert Counter(map(tuple, out.collect())) == trie_expected(turns)


def test_trie_of_few(spark):
    ddl = "conv_id long, turn int, role string, text string"
    assert prefix_trie.conversation_trie(spark.createDataFrame([], ddl)).count() == 0
    only = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 1)  # its one turn is replaced by none
    (root,) = prefix_trie.conversation_trie(spark.createDataFrame([(only, 1, "a", "b")], ddl)).collect()
    assert tuple(root) == (only, 0, None, 1, 0, 1, 0, sha(str(only)))


def test_radix_tree_layouts_and_paths():
    rng = random.Random(1)
    tree, keys = prefix_trie.Art(), {}
    for n in (2, 10, 40, 300, 3000):
        for _ in range(n):
            k = bytes(rng.choice(b"\x00\x01\xff") for _ in range(rng.randint(0, 40))) + rng.randbytes(rng.randint(0, 2))
            tree.put(k, n)
            keys[k] = n
    for i in range(256):
        tree.put(bytes([1, i, 9]), i)
        keys[bytes([1, i, 9])] = i
    assert all(tree.get(k) == v for k, v in keys.items())
    assert tree.get(b"\x07" * 50) is None
    seen, stack = set(), [tree.root]
    while stack:
        node = stack.pop()
        kinds = list(node.children.items())
        assert [b for b, _ in kinds] == [c.path[0] for _, c in kinds]
        seen.add((type(node.children).__name__, getattr(node.children, "size", 0)))
        stack += [c for _, c in kinds]
    assert seen == {("Small", 4), ("Small", 16), ("Indexed", 0), ("Full", 0)}


# ---- 13
def spelling_words(rows, least=7, least_count=2):
    run, n = re.compile("[A-Za-zÀ-ÿ]+"), Counter()
    for d, t in rows:
        for w in run.findall(t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def spelling_expected(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variants(rng, n_words=60):
    """Words over few letters, so that bigrams repeat inside words, and words at one edit of them."""
    base = ["".join(rng.choice("abÿ") for _ in range(rng.randint(7, 10))) for _ in range(n_words)]
    base += ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 14))) for _ in range(n_words)] + ["aaaaaaa", "abababab"]
    out = []
    for w in base:
        out += [w] * rng.choice([2, 3, 25, 300])
        for _ in range(3):
            i = rng.randint(0, len(w) - 1)
            out += [rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcÿ") + w[i:], w[:i] + "z" + w[i + 1:]])] * 2
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling(spark, seed):
    rng = random.Random(seed)
    said = variants(rng) + ["ghijklmn"] * 400 + ["ghijklmx"] * 30 + ["ghijklmxy"] * 2  # a chain of two forms
    rng.shuffle(said)
    cut = [said[i:i + 40] for i in range(0, len(said), 40)]
    rows = [(i if i % 9 else None, "×! ".join(w.upper() if rng.random() < 0.1 else w for w in ws)) for i, ws in enumerate(cut)]
    rows += [(1, None), (2, ""), rows[3], (77, "b" * 5000 + " " + "b" * 5000 + " short"), (78, "b" * 4999 + " " + "b" * 4999)]
    n = spelling_words(rows)
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id int, text string, word string, n int")
    want = spelling_expected(n)
    assert sum(f is not None for _, f, *_ in want) > 20 and any(r not in (w, f) for w, f, r, *_ in want)
    assert {tuple(r) for r in spelling.spelling_variants(df).collect()} == want
    if seed == 1:
        assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_near_words_with_hot_groups(spark):
    """Groups dealt to parts give the same links."""
    n = {w: 2 for w in variants(random.Random(9))}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    want = {(a, b) for a, b in itertools.permutations(n, 2) if one_edit(a, b)}
    got = spelling.near_words(words, group=4, share=1).collect()
    assert len(got) == len(want) and {(r["word"], r["near"]) for r in got} == want


def test_checksums_of_words():
    texts = ["Abc dé" + "f" * 200 + " ÀÿÖ×x", None, "", "q" * 64 + " " + "r" * 65]
    w = spelling.runs(texts)
    got = spelling.checksums(w, [b"1:", b"", b"22:", b":"])
    said = [w.data[s:e].tobytes() for s, e in zip(w.start, w.end, strict=True)]
    assert [x.decode() for x in said] == ["abc", "dé" + "f" * 200, "ÀÿÖ×x", "q" * 64, "r" * 65]
    assert got.tolist() == [zlib.crc32(p + x) for p, x in zip([b"1:"] * 3 + [b":"] * 2, said, strict=True)]
    assert W.strings(w.data, w.start[:0], w.end[:0]).to_pylist() == []
