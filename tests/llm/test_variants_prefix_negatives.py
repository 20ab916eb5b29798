"""Spelling variants, prefix BPE and hard negatives against brute force, on hand-made rows."""

import hashlib
import random
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgermill.llm import hardneg, prefix, spelling
from ledgermill.llm.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


# Spelling variants

def near(a, b):
    """Differ by one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(counts):
    forms, out = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 2 * n else None
        out[w] = (forms[w], len(others))
    rows = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, out[w][1], counts[forms[w]] if forms[w] else None))
    return sorted(rows, key=repr)


def made_words(rnd, alphabet, n, length):
    words = set()
    while len(words) < n:
        w = [rnd.choice(alphabet) for _ in range(rnd.randrange(*length))]
        for _ in range(4):  # a family of near words
            words.add("".join(w))
            at = rnd.randrange(len(w))
            w[at:at + rnd.randrange(2)] = rnd.choice(["", "a", "aa", "é"])
            w = w or ["a"]
    return {w: rnd.choice([1, 2, 3, 4, 8, 16, 40]) for w in words if w}


@pytest.mark.parametrize("longest", [48, 0, 6])
def test_variants_against_brute_force(spark, monkeypatch, longest):
    """As text, as digests, and where both meet at one length."""
    monkeypatch.setattr(spelling, "LONGEST_SPELT", longest)
    counts = made_words(random.Random(3), "aabéÿ", 400, (1, 10)) | made_words(random.Random(4), "abc", 40, (45, 52))
    df = spark.createDataFrame([(w, n, 7) for w, n in counts.items()], "word string, n bigint, num int")
    numbered = df.select("word", "n").orderBy("word").selectExpr("word", "n", "monotonically_increasing_id() AS num")
    # The threshold goes to the executors' Python as well, so digests are compared here in the driver's.
    if longest == 48:
        assert sorted(map(tuple, spelling.variants(df).collect()), key=repr) == by_hand(counts)
    rows = numbered.collect()
    groups = {}
    for r in rows:
        word = r["word"]
        spelt = lambda n: n <= longest
        skipped, whole = spelling.rotation_digests(word)
        for i in range(len(word)):
            key = word[i + 1:] + "\n" + word[:i] if spelt(len(word) - 1) else skipped[i].tobytes()
            groups.setdefault(key, []).append((word, False, i == 0 or word[i] != word[i - 1]))
        for i in range(len(word) + 1):
            key = word[i:] + "\n" + word[:i] if spelt(len(word)) else whole[i].tobytes()
            groups.setdefault(key, []).append((word, True, True))
    found = [(a, b) for g in groups.values() for (a, la, fa), (b, lb, fb) in product(g, g)
             if a != b and (fb if la else not lb or fa)]
    want = [(a, b) for a in counts for b in counts if near(a, b)]
    assert sorted(found) == sorted(want)  # every pair once


def test_a_word_without_end_is_compared_whole(spark):
    long = "ab" * 30_000
    counts = {long: 9, long[:-1]: 3, long[:500] + "x" + long[500:]: 4, long[:500] + "x" + long[501:]: 2, "short": 1}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = {r["word"]: r for r in spelling.variants(df).collect()}
    assert got[long]["n_near"] == 3 and got[long]["form"] is None
    assert got[long[:-1]]["form"] == long and got["short"]["root"] == "short" and got["short"]["n_near"] == 0


def test_words_of_texts(spark):
    rows = [(1, "Straße ÉCOLE-école x1école"), (2, None), (None, "straße Straße"), (3, ""), (3, "abcde ABCDE abcdE")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, run string")
    found = spelling.runs(df)
    assert sorted(r["run"] for r in found.where("id = 1").collect()) == sorted(["straße", "École", "école", "x", "école"])
    got = {r["word"]: r["n"] for r in spelling.words(found).collect()}
    assert got == {"straße": 3, "abcde": 3}  # only A to Z are lower-cased: École and école are two words
    planted = spelling.misspelt(found, 1)
    # One in one: every run loses a code point.
    assert sorted(len(r["run"]) for r in planted.collect()) == sorted(len(r["run"]) - 1 for r in found.collect())
    assert spelling.variants(spelling.words(found.limit(0))).count() == 0


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(i, i + 1) for i in range(37)] + [(100, 20)], "num bigint, form bigint")
    assert {r["num"]: r["root"] for r in spelling.roots(forms).collect()} == {**dict.fromkeys(range(37), 37), 100: 37}


# Prefix BPE

ALPHABET = "aaab  \n\t'sl.,-=_éß中文🙂0123ABC\x1c "


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    ranks = prefix.read_ranks(public_tokenizers.path(request.param))
    return prefix.Encoder(ranks, public_tokenizers.PATTERN), tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encodes_as_the_library(both):
    mine, library = both
    rnd = random.Random(1)
    texts = ["".join(rnd.choices(ALPHABET, k=rnd.randrange(60))) for _ in range(2000)]
    texts += ["", "a" * 5000, " " * 5000 + "x", "-" * 3000, "ab" * 3000, "\n" * 3000, "<|endoftext|> a"]
    assert mine.encode_all(texts) == [library.encode_ordinary(t) for t in texts]
    assert all(mine.decode(mine.encode(t)) == t.encode() for t in texts)


def test_edits_and_appends_keep_texts_encoded(both):
    mine, library = both
    rnd = random.Random(2)
    for _ in range(150):
        text = "".join(rnd.choices(ALPHABET, k=rnd.randrange(200)))
        edited = prefix.Edited(mine, text)
        for _ in range(6):
            a = rnd.randrange(len(text) + 1)
            b, new = min(len(text), a + rnd.randrange(4)), "".join(rnd.choices(ALPHABET, k=rnd.randrange(4)))
            text = text[:a] + new + text[b:]
            edited.edit(a, b, new)
            assert edited.text == text and edited.ids() == library.encode_ordinary(text)


def test_an_edit_finds_only_what_is_near_it(both):
    ranks = both[0].ranks
    data = bytes(random.Random(3).choices(b"etaoin shrdlu", k=20_000))
    p = prefix.Prefixes(ranks, data)
    assert p.edit(10_000, 10_003, b"zzq") < 1000
    assert p.last == prefix.Prefixes(ranks, p.data).last and len(p.data) == 20_000
    q = prefix.Prefixes(ranks, data[:9000])
    before = q.last[:]
    q.append(data[9000:])
    assert q.last[:9000] == before and q.ids() == prefix.Prefixes(ranks, data).ids()


def test_ranks_must_have_all_bytes():
    with pytest.raises(ValueError):
        prefix.Encoder({b"a": 0}, public_tokenizers.PATTERN)


def test_prefix_frames(spark, both):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = [(1, "hello  world"), (1, "hello  world"), (None, None), (2, ""), (3, "x" * 300_000 + " é")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, ids string")
    out = prefix.encode(df, path, public_tokenizers.PATTERN)
    back = {r["id"]: bytes(r["data"]).decode() for r in prefix.decode(out, path, public_tokenizers.PATTERN).collect()}
    assert out.count() == 5 and back == {1: "hello  world", None: "", 2: "", 3: rows[4][1]}
    assert prefix.encode(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_op12_against_the_library(spark):
    ranks = prefix.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want.add((r["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode_bytes(ids))))
    assert {tuple(r) for r in QUERIES["op12_prefix_bpe"](spark, SF).collect()} == want


# Hard negatives

def mined(rows, every, k=5, m=3):
    """(row, label, vector) triples by the contract; rows are told apart by place."""
    use = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, lab, v in rows
           if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for p, (i, lab, v) in enumerate(use):
        if i % every:
            continue
        scored = sorted(((-dot(v, w), j, other) for q, (j, other, w) in enumerate(use) if q != p), key=lambda x: x[:2])
        for s, j, _ in [x for x in scored if x[2] == lab][:k]:
            fit = [x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s][:m]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(8192, 65_536, 1024, 128), (3, 10, 4, 5)])
def test_negatives_against_brute_force(spark, monkeypatch, sizes):
    """Whole, and cut into many blocks and slices."""
    for name, n in zip(("BLOCK", "SLICE", "LEAST_SLICE", "STEP"), sizes, strict=True):
        monkeypatch.setattr(hardneg, name, n)
    rnd = random.Random(5)
    rows = []
    for i in range(160):
        v = [rnd.choice([-1., -.5, 0., .25, .5, 1.]) for _ in range(4)] if i % 3 else [.5, .5, .25, 0.]  # many ties, a third alike
        rows.append((i, rnd.choice([0, 0, 0, 1, 2]), v))
    rows += [(None, 1, [1.] * 4), (200, None, [1.] * 4), (210, 1, None), (220, 1, [1., None, 1., 1.]),
             (230, 1, [float("nan"), 1., 1., 1.]), (240, 1, [float("inf"), 0., 0., 0.]), (250, 0, [1., 1.]), (260, 5, [9., 9., 9., 9.])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id bigint, label int, embedding array<float>, num string")
    got = sorted(map(tuple, hardneg.mine(df, every=10).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))
    assert got == mined(rows, 10) and len(got) > 100
    assert hardneg.mine(df.limit(0), every=10).count() == 0


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = [(10, 1, [1., 0.])] * 2 + [(11, 2, [.9, 0.])] * 4 + [(13, 1, [1., 0.])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    got = sorted(map(tuple, hardneg.mine(df, every=10).collect()))
    assert got == mined(rows, 10) and {g[1] for g in got} == {10, 13}


def test_scores_beyond_double_precision_are_exact():
    a = np.array([[1 << 26, 3]] * 2)
    b = np.array([[(1 << 26) - 1, 1], [1 << 26, -1]])
    assert hardneg._products(a, b).tolist() == [[(1 << 26) * ((1 << 26) - 1) + 3, (1 << 52) - 3]] * 2
