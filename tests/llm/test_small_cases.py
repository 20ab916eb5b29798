"""Each operator on hand-made rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import math
import random
import zlib
from bisect import bisect_right
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgermill.llm import (bpe, chat, codec, exact, graph, lattice, linededup, mixing, ngramjoin, quality, sharding,
                            tokencount)

WORDS = "the of and to in that is was for on with as by at from it an be this which".split()


def joined(pairs, nodes):
    """Smallest reachable node of each."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def text(rnd, n, words=WORDS):
    return " ".join(rnd.choice(words) + str(rnd.randrange(99)) for _ in range(n))


# Sharding

def test_shards_move_only_to_the_new_one_and_slots_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 4)
    rows = [(i % 300, "x", 7) for i in range(400)] + [(None, "n", 1)] * 3 + [(5, "x", 7)] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, best string, slot int")
    placed = sharding.assign(df, "doc_id", [(i, 1.0) for i in range(4)], grown=(4, 1.0))
    got = sharding.number(placed, "shard", "doc_id", placed.columns).collect()
    assert len(got) == len(rows)
    assert all(r["grown_shard"] in (r["shard"], 4) for r in got)
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert sharding.number(placed.limit(0), "shard", "doc_id", placed.columns).count() == 0


def test_shares_follow_the_weights(spark):
    got = sharding.assign(spark.range(8000), "id", [(0, 1.0), (1, 3.0)]).groupBy("shard").count().collect()
    assert abs({r["shard"]: r["count"] for r in got}[1] / 8000 - 0.75) < 0.02


# Mixing

def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame([("a", "en", "p", 100), ("a", "de", "p", 300), ("b", "en", "p", 500), ("b", "de", "q", 50)],
                                  "source string, lang string, topic string, tokens bigint")
    t = lambda name, *v: spark.createDataFrame(v, f"{name} string, target double")
    out = mixing.rake(cells, {"source": t("source", ("a", .5), ("b", .5)), "lang": t("lang", ("en", .7), ("de", .3))})
    rows = out.collect()
    share = lambda c, v: sum(r["tokens"] / 950 * r["factor"] for r in rows if r[c] == v)
    assert abs(share("source", "a") - .5) < 1e-8 and abs(share("lang", "en") - .7) < 1e-8
    with pytest.raises(ValueError):  # topic q has only source b and lang de
        mixing.rake(cells, {"source": t("source", ("a", .9), ("b", .1)), "topic": t("topic", ("p", .2), ("q", .8))}, sweeps=15)


@pytest.mark.parametrize("own", ["one language more", "a language each"])
def test_sources_with_a_language_of_their_own(spark, own):
    langs = {"a": ["en"], "b": ["de"], "c": ["fr"]} if own == "a language each" else {"a": ["en", "de"], "b": ["en", "de"], "c": ["xx"]}
    rnd = random.Random(6)
    rows = [(i, text(rnd, 5 + i % 40) + (" http" if i % 5 == 0 else ""), s, langs[s][i // 7 % len(langs[s])])
            for i in range(300) for s in ["aaaabbc"[i % 7]]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    measured = mixing.measure(df)
    got = mixing.probabilities(measured).collect()
    assert len(got) == measured.select("source", "lang", "topic").distinct().count()
    assert all(0 < r["probability"] <= 1 for r in got) and max(r["probability"] for r in got) == 1
    cells = measured.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    targets = mixing.tempered(cells, ["source", "lang", "topic"], mixing.POWER)
    off = {(r["margin"], r["value"]): (r["target"], r["share"])
           for r in mixing.missed(mixing.rake(cells, targets, strict=False), targets).collect()}
    # The share of the source and its language is one number, between the two targets.
    (t, x), (u, y) = off["source", "c"], off["lang", langs["c"][0]]
    assert abs(x - y) < 1e-9 and min(t, u) - 1e-9 <= x <= max(t, u) + 1e-9
    assert max(abs(t - x) for t, x in off.values()) < 0.1
    assert mixing.sample(df).count() > 0


def test_sample_handles_nulls_and_clashing_names(spark):
    rows = [(i, None if i % 7 == 0 else f"w{i} w", "s" if i % 3 else None, "en", 1.0) for i in range(60)] + [(None, "", "s", None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, probability double")
    got = mixing.sample(df)
    assert got.columns == df.columns and {tuple(r) for r in got.collect()} <= {tuple(r) for r in df.collect()}
    assert mixing.sample(df.limit(0)).count() == 0


def test_sample_keeps_or_drops_repeated_rows_together(spark):
    rnd = random.Random(12)
    rows = [(i, text(rnd, 3 + i % 50), "abc"[i % 5 // 2], "en" if i % 4 else "de") for i in range(90) for _ in range(1 + i % 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    got = mixing.sample(df).collect()
    for i in range(90):
        assert sum(r["doc_id"] == i for r in got) in (0, 1 + i % 3)
    assert 0 < len({r["doc_id"] for r in got}) < 90
    # A row that comes twice weighs twice: probabilities are those of the table without ids.
    chance = lambda d: {tuple(r)[:3]: r["probability"] for r in mixing.probabilities(mixing.measure(d)).collect()}
    twice, once = chance(df.unionByName(df)), chance(df)
    assert twice.keys() == once.keys() and all(abs(twice[k] - once[k]) < 1e-9 for k in once)


# Chat

def test_every_text_survives_the_round_trip():
    rnd = random.Random(2)
    parts = ["<", "\\", "[", "/", "s>", "</s>", "[INST]", "[/INST] ", "<<SYS>>", "<<ROLE 61>> ", "<\\/s>", "INST]", "ok", "\n", ">"]
    for _ in range(3000):
        t, role = "".join(rnd.choices(parts, k=rnd.randrange(9))), rnd.choice(["user", "assistant", "system", None, "", "a>> b"])
        out, a, b = chat.render(role, t)
        assert chat.parse(out) == [(role, t)] and chat.unescape(out[a:b]) == t


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "</s>"), (None, None, None, "x"), (2, 5, "assistant", "y" * 200_000)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "conv_id bigint, turn bigint, role string, text string, rendered int")
    got = {r["conv"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\n</s>\nassistant\n</s>\n") and got[1]["loss_sha256"] == sha("</s></s>")
    assert got[None]["n_turns"] == 1 and got[None]["loss_chars"] == 0 and got[2]["loss_chars"] == 200_000
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# Quality

def test_quality_learns_from_no_held_out_label(spark):
    rnd = random.Random(14)
    junk = lambda: "".join(rnd.choice("#$%=~0123456789 ") for _ in range(120))
    rows = [(i, text(rnd, 20 + i % 40) + "." if i % 2 else junk(), "x") for i in range(240)]
    rows += [(7, text(rnd, 30), "x"), (7, None, "x"), (1000, text(rnd, 60_000), "x"), (None, junk(), "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    mark = [(i, i % 2) for i in range(240)]
    held = {i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1}
    table = lambda marks: spark.createDataFrame(marks, "doc_id bigint, quality int")
    model = quality.train(docs, table(mark))
    got = docs.select("doc_id", "text", quality.score(model).alias("p")).collect()
    assert len(got) == len(rows) and all(0 <= r["p"] <= 1 for r in got)
    assert all((r["p"] >= .5) == bool(r["doc_id"] % 2) for r in got[:240]) and 60 < len(held) < 100
    # Only labels that are held out differ: not one score does.
    other = quality.train(docs, table([(i, 1 - q if i in held else q) for i, q in mark]))
    assert [r[0] for r in docs.select(quality.score(other)).collect()] == [r["p"] for r in got]
    # A score is one entry of each table, added up by hand.
    for r in got:
        x = quality.features((r["text"] or "").encode())
        total = model.intercept + sum(t[bisect_right(list(e), v)] for t, e, v in zip(model.tables, model.edges, x, strict=True))
        rough = [bisect_right(list(e), v) for e, v in zip(model.coarse, x, strict=True)]
        total += sum(g[rough[i], rough[j]] for g, (i, j) in zip(model.grids, model.pairs, strict=True))
        assert abs(1 / (1 + math.exp(-total)) - r["p"]) < 1e-9
    # Rows beyond max_rows are not learnt from, and the model is still one of both labels.
    few = quality.train(docs, table(mark), max_rows=40)
    p = [r[0] for r in docs.where("doc_id < 240").select(quality.score(few)).collect()]
    assert p != [r["p"] for r in got if r["doc_id"] is not None and r["doc_id"] < 240] and max(p) > .5 > min(p)


def test_quality_without_labels_and_with_bad_ones(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "a b c", 0.5), (3, "good words here", 0.5)], "doc_id bigint, text string, score double")
    none = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id bigint, quality int")
    model = quality.train(docs, none)
    assert {r[0] for r in docs.select(quality.score(model)).collect()} == {0.5}
    assert docs.limit(0).select(quality.score(model)).count() == 0


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > .5) != (x[:, 1] > .5)).astype(float)
    assert ((quality.fit(x, y, rounds=30, pairs=2).score(x) >= .5) == y).mean() > .97
    assert ((quality.fit(x, y, rounds=30, pairs=0).score(x) >= .5) == y).mean() < .8


# Lines

def _norm(line):
    return regex.sub(r"\p{N}", "0", regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower())).strip(" ")


def _simhash(norm):
    words, out = norm.split(" "), 0
    for p in range(0, len(words), linededup.PART):
        part = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words[p:p + linededup.PART]]
        out ^= sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > len(part))
    return out


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _line_groups(docs):
    first, at = {}, []
    for i, t in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        for p, line in enumerate(t.split("\n")):
            if (n := _norm(line)).count(" ") >= 4:
                at.append((i, p, n))
                first.setdefault(n, (i, p))
    code = {n: _simhash(n) for n in first}
    close = [(first[a], first[b]) for a, b in combinations(first, 2) if (code[a] ^ code[b]).bit_count() <= 3
             and 5 * _edits(a.split(" "), b.split(" ")) <= max(len(a.split(" ")), len(b.split(" ")))]
    assert close
    of = joined(close, first.values())
    return sorted({(i, p, *of[first[n]], (i, p) == of[first[n]]) for i, p, n in at})


@pytest.mark.parametrize("small", [24, 2])
def test_lines_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(linededup, "SMALL", small)
    rnd = random.Random(4)
    base = [text(rnd, n) for n in (6, 40, 70, 90)]
    docs = []
    for i in range(36):
        words = rnd.choice(base).split(" ")
        words[rnd.randrange(len(words))] += "x"
        docs.append((i, "Short one\n" + " ".join(words) + "\n" + rnd.choice(base) + ("\n" + "a b c " * 3000 if i < 2 else "")))
    docs += [(50, None), (51, ""), docs[3]]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, pos int, cid int")
    got = sorted({tuple(r) for r in linededup.groups(df).select("id", "pos", "group_id", "group_pos", "kept").collect()})
    assert got == _line_groups(docs)
    gone = {(r[0], r[1]) for r in got if not r[4]}
    want = sorted((i, t and "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone)) for i, t in docs)
    assert sorted((r["doc_id"], r["text"]) for r in linededup.dedup(df).collect()) == want
    assert linededup.dedup(df.limit(0)).count() == 0


def _plain(line):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ") or regex.sub(r"\s+", " ", line).strip(" ")


def test_whole_lines_against_brute_force_on_edit_similarity_alone(spark):
    rnd = random.Random(7)
    letters = "abcdefghijklmnopqrst"
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 9)))
    lines = []
    for n in (1, 2, 3, 4, 6, 10, 20, 40, 80) * 6:
        line = " ".join(word() for _ in range(n))
        lines.append(line)
        words = line.split(" ")
        for _ in range(max(n // 7, 1)):  # words replaced
            words[rnd.randrange(n)] = word()
        lines.append(" ".join(words))
        typos = list(line)
        for _ in range(max(len(line) // 8, 1)):  # letters replaced
            typos[rnd.randrange(len(typos))] = rnd.choice(letters)
        lines.append("".join(typos))
    run = "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(60))
    lines += [run, run[:20] + run[21:], "-----", "-----", "Menu", "menu!", "\r", " ", "", "12 34 56 78 90", "98 76 54 32 10"]
    docs = [(i, "\n".join(lines[i::9])) for i in range(9)] + [(50, None), (51, "")]
    at = [(i, p, n) for i, t in docs if t for p, x in enumerate(t.split("\n")) if (n := _plain(x))]
    first = {}
    for i, p, n in at:
        first.setdefault(n, (i, p))
    similar = lambda a, b: abs(len(a) - len(b)) * 5 <= max(len(a), len(b)) and 5 * _edits(a, b) <= max(len(a), len(b))
    close = [(a, b) for a, b in combinations(first, 2) if similar(a, b)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r["id"], r["pos"]): r for r in linededup.whole_groups(df).collect()}
    assert sorted(got) == sorted((i, p) for i, p, _ in at)
    name = {n: (got[x]["group_id"], got[x]["group_pos"]) for n, x in first.items()}
    assert all((got[i, p]["group_id"], got[i, p]["group_pos"]) == name[n] for i, p, n in at)
    of = joined([(first[a], first[b]) for a, b in close], first.values())
    assert all(of[x] == of[name[n]] for n, x in first.items())  # no line is with another that brute force does not link
    found = [name[a] == name[b] for a, b in close]
    assert len(found) > 60 and sum(found) >= 0.97 * len(found)
    assert all(name[a] == name[b] for a, b in close if max(len(a), len(b)) < linededup.SHORT)
    assert name[run] == name[run[:20] + run[21:]] and name["12 34 56 78 90"] != name["98 76 54 32 10"]
    assert linededup.whole_groups(df.limit(0)).count() == 0


def _first_of(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id bigint, text string")
    return {r["id"]: r["group_id"] for r in linededup.whole_groups(df).collect()}


def test_short_lines_and_lines_without_blanks_are_compared_and_returned(spark):
    rnd = random.Random(8)
    run = "".join(chr(0x3042 + rnd.randrange(60)) for _ in range(90))
    lines = ["Home", "home!", "Contact us", "Contact  us.", "* * *", "* * *", run, run[:30] + "x" + run[31:], "", " \t", "Imprint"]
    assert _first_of(spark, lines) == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 6: 6, 7: 6, 10: 10}


def test_lines_are_verified_by_characters(spark, monkeypatch):
    five = "breakfast afternoon understanding telephone yesterday"
    ocr = " ".join("the quick brown foxes jumped over seventeen sleeping watchdogs".split() * 3)
    lines = [five, five.replace("kf", "xf").replace("ph", "qh"), ocr, ocr.replace("ee", "ec").replace("ox", "0x").replace("ui", "ul")]
    words = [sum(a != b for a, b in zip(x.split(), y.split(), strict=True)) / len(x.split()) for x, y in zip(lines[::2], lines[1::2], strict=True)]
    assert min(words) > .2  # by words they differ too much
    assert _first_of(spark, lines) == {0: 0, 1: 0, 2: 2, 3: 2}
    monkeypatch.setattr(linededup, "LONG", 20)  # above it, words count
    assert _first_of(spark, lines) == {0: 0, 1: 1, 2: 2, 3: 3}


@pytest.mark.parametrize("size", [6, 30, 300])
def test_lines_copied_often_are_found_as_well_as_others(spark, size):
    """Near copies of one line, all with a run that every other line has too, and skeletons whose slots differ."""
    rnd = random.Random(size)
    letters = "abcdefghijklmnopqrst"
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randrange(3, 9)))
    boiler = " all rights reserved by the owner"
    lines, of = [], []
    for g in range(max(90 // size, 2)):
        base = " ".join(word() for _ in range(10)) + boiler
        for _ in range(size):
            line = list(base)
            for k in rnd.sample(range(len(base) - len(boiler)), round(len(base) * .07)):
                line[k] = rnd.choice(letters)
            lines.append("".join(line))
            of.append(g)
    skeleton = "order {} of customer {} was shipped to the depot on the agreed date"
    lines += [skeleton.format(word(), word()) for _ in range(size)]
    of += [-1] * size
    order = rnd.sample(range(len(lines)), len(lines))
    df = spark.createDataFrame([(i, lines[k]) for i, k in enumerate(order)], "doc_id bigint, text string")
    name = {r["id"]: r["group_id"] for r in linededup.whole_groups(df).collect()}
    of, lines = [of[k] for k in order], [lines[k] for k in order]
    pairs = [(i, j) for i, j in combinations(range(len(lines)), 2) if of[i] == of[j]]
    some = rnd.sample(pairs, min(len(pairs), 1500))
    close = [(i, j) for i, j in some if 5 * _edits(lines[i], lines[j]) <= max(len(lines[i]), len(lines[j]))]
    found = sum(name[i] == name[j] for i, j in close)
    assert len(close) > .8 * len(some) and found >= .97 * len(close), (found, len(close))
    assert all(of[i] == of[name[i]] for i in range(len(lines)))


@pytest.mark.parametrize("block", [2048, 8])
def test_lines_whose_only_common_run_is_frequent_all_link(spark, monkeypatch, block):
    """30 pairs that share one run, which is in all lines, and have other characters beside it."""
    monkeypatch.setattr(linededup, "BLOCK", block, raising=False)
    rnd, letters = random.Random(11), "abcdefghijklmnopqrstuvwxyz"
    # A run that is sampled of lines of 60 characters: those with an even hash are.
    run = next(r for r in ("".join(rnd.choices(letters, k=12)) for _ in range(100))
               if not spark.range(1).select(F.xxhash64(F.lit(r))).first()[0] & 1)
    lines = []
    for _ in range(30):
        rest = rnd.choices(letters, k=48)
        other = [letters[letters.index(c) - 1] if i in (2, 12, 22, 23, 25, 35, 45) else c for i, c in enumerate(rest)]
        lines += ["".join(x[:24]) + run + "".join(x[24:]) for x in (rest, other)]
    assert all(_edits(a, b) == 7 for a, b in zip(lines[::2], lines[1::2], strict=True))
    assert _first_of(spark, lines) == {i: i - i % 2 for i in range(60)}


@pytest.mark.parametrize("odd", [0, 1])
def test_lines_with_one_common_run_link_whatever_its_hash(spark, odd):
    rnd, letters = random.Random(12), "abcdefghijklmnopqrstuvwxyz"
    run = next(r for r in ("".join(rnd.choices(letters, k=12)) for _ in range(100))
               if spark.range(1).select(F.xxhash64(F.lit(r))).first()[0] & 1 == odd)
    line = "".join(rnd.choices(letters, k=24)) + run + "".join(rnd.choices(letters, k=24))
    other = "".join(letters[letters.index(c) - 1] if i in (2, 7, 12, 17, 23, 36, 43, 48, 53) else c for i, c in enumerate(line))
    assert _edits(line, other) == 9 and _first_of(spark, [line, other, "another line that stands by itself here"]) == {0: 0, 1: 0, 2: 2}


def test_lines_compared_by_words_may_differ_in_characters(spark, monkeypatch):
    monkeypatch.setattr(linededup, "LONG", 40)
    line = "the quick brown foxes jumped over seventeen sleeping watchdogs of ours"
    assert _first_of(spark, [line, line.replace("sleeping", "s" * 40)]) == {0: 0, 1: 0}


def test_whole_lines_keep_repeated_rows_null_ids_and_clashing_names(spark):
    docs = [(None, "the same line of text\nanother line stands here"), (1, "the same line of text"), (1, "the same line of text"),
            (2, "a line of its own in this text\nThe same line, of text"), (3, None), (4, "")]
    df = spark.createDataFrame([(*d, 1, 2, 3, "k") for d in docs], "doc_id bigint, text string, pos int, cid int, code int, key string")
    got = sorted((tuple(r) for r in linededup.whole_groups(df).drop("body").collect()), key=str)
    assert got == sorted([(None, 0, None, 0, True), (None, 1, None, 1, True), (1, 0, None, 0, False), (1, 0, None, 0, False),
                          (2, 0, 2, 0, True), (2, 1, None, 0, False)], key=str)
    back = sorted((tuple(r) for r in linededup.dedup(df, find=linededup.whole_groups).collect()), key=str)
    want = [docs[0], (1, ""), (1, ""), (2, "a line of its own in this text"), (3, None), (4, "")]
    assert back == sorted([(*d, 1, 2, 3, "k") for d in want], key=str)


def test_a_text_of_very_many_equal_lines(spark):
    text = "\n".join(["first line of them", *["the same old line"] * 150_000, "last line"])
    df = spark.createDataFrame([(1, text), (2, "x\nlast line\n\ny")], "doc_id bigint, text string")
    got = dict(tuple(r) for r in linededup.dedup(df, find=linededup.whole_groups).collect())
    assert got == {1: "first line of them\nthe same old line\nlast line", 2: "x\n\ny"}


def test_block_masks_cover_every_choice():
    for n in (10, 10 ** 6, 10 ** 11):
        masks = linededup.blocks(n)
        for bits in ((0, 1, 2), (5, 30, 63), (15, 16, 48)):
            assert any(not any(m >> b & 1 for b in bits) for m in masks)


# Tokenizers

@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(1)
    parts = list("aabtth  \n\t'sdl.,!09ÀéñΣσςİßŒ中か한👩‍\x1c\x85​\r٣²Ǆά") + ["<|endoftext|>", "<|startoftext|>", "'ll", "'RE", "ΑΣ", "thththth"]
    return ["".join(rnd.choices(parts, k=rnd.randrange(50))) for _ in range(2000)] + ["", "a" * 3000, " " * 500, "ab" * 2000]


def test_codec_is_the_library(spark, odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    df = spark.createDataFrame([*enumerate(odd_texts), (None, None)], "doc_id bigint, text string").withColumn("ids", F.lit(1))
    got = {r["id"]: r for r in codec.encode(df, path).collect()}
    want = lib.encode_batch(odd_texts, add_special_tokens=False)
    assert all(list(got[i]["ids"]) == w.ids for i, w in enumerate(want)) and got[None]["n_tokens"] == 0
    back = {r["id"]: r["text"] for r in codec.decode(codec.encode(df, path), path).collect()}
    assert [back[i] for i in range(len(want))] == lib.decode_batch([w.ids for w in want], skip_special_tokens=False)
    assert codec.round_trip(df, path).where("NOT same").count() == 0 and codec.encode(df.limit(0), path).count() == 0


def test_counts_are_the_library(spark, odd_texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([*enumerate(odd_texts), (None, None)], "doc_id bigint, text string").withColumn("n_tokens", F.lit(1))
    got = {r["id"]: r for r in tokencount.count_tokens(df, path, limit=20).collect()}
    want = Tokenizer.from_file(path).encode_batch(odd_texts, add_special_tokens=False)
    assert all(got[i]["n_tokens"] == len(w.ids) and got[i]["over_limit"] == (len(w.ids) > 20) for i, w in enumerate(want))
    assert (got[None]["n_bytes"], got[None]["n_tokens"]) == (0, 0)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_the_proof_of_whole_tokens_agrees_with_merging(name):
    merges, _ = bpe.load(public_tokenizers.path(name))
    whole, end = merges.whole(), len(merges.suffix)
    for i, s in list(enumerate(merges.strings))[::7]:
        if s.endswith(merges.suffix):
            assert whole[i] == (merges.merge(s[:len(s) - end]) == [i])


def test_compatible_pairs_of_a_small_vocabulary():
    vocab = {s: i for i, s in enumerate(["a", "b", "aa", "ab", "aab", "aaaa"])}
    m = bpe.Merges(vocab, [("a", "a"), ("a", "b"), ("aa", "b"), ("aa", "aa")])
    for word in ("".join(c) for n in range(1, 8) for c in __import__("itertools").product("ab", repeat=n)):
        ids = m.merge(word)
        assert m._merge_long([vocab[c] for c in word]) == ids
        assert m.compatible(np.array(ids[:-1], int), np.array(ids[1:], int)).all()
    assert not m.compatible(np.array([0]), np.array([2])).any() and m.compatible(np.array([2]), np.array([0])).all()


# Exact

def test_stream_goes_on_and_checks_full_bytes(spark, tmp_path):
    rows = [(5, "a b"), (3, "ab"), (9, None), (8, " \n"), (None, "ab  "), (2, "x" * 100_000), (2, "x" * 100_000), (7, "ba")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, digest int")
    df.write.parquet(f"{tmp_path}/in")
    weak = lambda t: F.length(t).cast("string").cast("binary")

    def groups(**more):
        out = exact.dedup(spark, f"{tmp_path}/in", **more).collect()
        return sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in out)

    want = sorted([("5", "None", 3, False), ("3", "None", 3, False), ("None", "None", 3, True), ("9", "8", 2, False),
                   ("8", "8", 2, True), ("2", "2", 2, True), ("2", "2", 2, False), ("7", "7", 1, True)])
    work = f"{tmp_path}/work"
    assert groups(work=work) == want == groups(digest=weak)
    spark.createDataFrame([(1, "a\tb  ", 1), (4, "ba", 1)], df.schema).write.mode("append").parquet(f"{tmp_path}/in")
    got = groups(work=work, batch_bytes=1)
    assert ("1", "1", 4, True) in got and ("7", "4", 2, False) in got and len(got) == 10
    df.limit(0).write.parquet(f"{tmp_path}/none")
    assert exact.dedup(spark, f"{tmp_path}/none").count() == 0


# N-grams

def _shingles(t, k):
    w = [x.decode() for x in (t or "").encode().lower().split()]
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


@pytest.mark.parametrize("frequent", [16, 2, 0])
def test_ngram_links_against_brute_force(spark, frequent):
    rnd = random.Random(frequent)
    base = [text(rnd, n) for n in (3, 7, 20, 60, 120, 400)]
    docs = []
    for i in range(150):
        words = rnd.choice(base).split(" ")
        for _ in range(rnd.choice((0, 1, 1, 2, 4, 9))):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        docs.append((i, " ".join(words + (base[2].split(" ") if i % 4 == 0 else [])).replace(" ", rnd.choice((" ", "\n "))).upper()))
    docs += [(200, None), (201, " \t"), (202, "one"), (203, "ONE"), (3, docs[3][1]), (204, docs[3][1]), (205, "é É é É")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, node int")
    sets = {(i, t): _shingles(t, 4) for i, t in docs}
    close = [(a[0], b[0]) for a, b in combinations(sets, 2) if (i := len(sets[a] & sets[b])) and 100 * i >= 85 * len(sets[a] | sets[b])]
    of = joined(close, [d[0] for d in docs])
    got = sorted((r["id"], r["n_shingles"], r["component_id"]) for r in ngramjoin.link(df, frequent=frequent).collect())
    assert got == sorted((i, len(sets[i, t]), of[i]) for i, t in docs)
    if frequent == 2:
        kept = sorted((r["doc_id"], r["text"]) for r in ngramjoin.dedup(df, frequent=2).collect())
        assert kept == sorted({(i, t) for i, t in docs if of[i] == i}, key=lambda d: d[0])
        assert ngramjoin.dedup(df.limit(0)).count() == 0


# Vectors

def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((40, 64))
    x = np.concatenate([base, *(b + rng.standard_normal((k, 64)) * s for b, k, s in zip(
        base, rng.integers(0, 12, 40), rng.choice([.1, .2, .28], 40), strict=True)), base[:20], base[:3]])
    odd = [(5000, None), (5001, [1.0, None]), (5002, [float("nan")] * 64), (5003, []), (5004, [1.0, 2.0]), (5005, [2.0, 4.0]),
           (5006, [0.0] * 64), (None, [1.0] * 64)]
    df = spark.createDataFrame([*((i, [float(v) for v in r]) for i, r in enumerate(x)), *odd], "vec_id bigint, embedding array<double>")
    got = {r["id"]: r for r in lattice.near_duplicates(df.withColumn("cid", F.lit(1))).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= .95
    np.fill_diagonal(near, False)
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= near.sum(1)).all() and links.sum() >= .95 * near.sum()
    of = joined(zip(*np.nonzero(near), strict=True), range(len(x)))
    assert sum(got[i]["component_id"] != of[i] for i in range(len(x))) <= 2
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (5000, 5001, 5002, 5003, 5006, None))
    assert (got[5005]["component_id"], got[5005]["n_links"], got[5005]["kept"]) == (5004, 1, False)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_lattice_points_are_nearest():
    x = np.random.default_rng(3).standard_normal((200, 8)) * 2
    p, near = lattice.nearest(x), lattice.neighbours()
    own = ((x - p) ** 2).sum(1)
    assert (((x[:, None] - p[:, None] - near) ** 2).sum(2) >= own[:, None] - 1e-9).all()
    assert len({tuple(v) for v in near}) == 240 and ((near ** 2).sum(1) == 2).all()


def test_components_of_chains_and_hubs(spark):
    rnd = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(9, 9), (None, 1)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    real = [p for p in pairs if None not in p and p[0] != p[1]]
    assert got == joined(real, {n for p in real for n in p})


def test_ngram_links_with_a_passage_in_a_third_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "SMALL", 2)
    monkeypatch.setattr(ngramjoin, "BLOCK", 5)
    rnd = random.Random(12)
    passage = text(rnd, 120)
    docs = [passage + " " + text(rnd, rnd.choice([8, 14, 30])) if i % 3 == 0 else text(rnd, 60) for i in range(90)]
    sets = [{tuple(w[i:i + 4]) for i in range(len(w) - 3)} for w in (d.split() for d in docs)]
    links = [(a, b) for a, b in combinations(range(90), 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    of = joined(links, range(90))
    assert links and len({of[i] for i in range(0, 90, 3)}) > 5
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    got = {r["id"]: r["component_id"] for r in ngramjoin.link(df, frequent=2).collect()}
    assert got == {i: of[i] for i in range(90)}
