"""The queries on the given tables, against SQL where there is some."""

import hashlib
import random
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

import corpus_pipeline
from ledgermill.llm import mixing
from ledgermill.llm.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in ("documents", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, engine, name):
    df = QUERIES[name](spark, SF)
    cursor = engine.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    want = sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in cursor.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr([r[c] for c in sorted(names)]) for r in df.collect()) == want


def test_quality_on_held_out_labels(spark, engine):
    got = {r["doc_id"]: r for r in QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [got[i]["predicted"] == q for i, q in labels if got[i]["held_out"]]
    assert len(held) > 80 and sum(held) / len(held) > 0.95


def test_pipeline(spark, engine):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append({r["doc_id"]: r for r in docs.collect()})
    bad = {r[0] for r in engine.execute("SELECT doc_id FROM labels WHERE quality = 0").fetchall()}
    good = {r[0] for r in engine.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    assert not bad & seen[0].keys() and good <= seen[0].keys()
    assert seen[1].keys() == seen[0].keys() and seen[2].keys() < seen[1].keys() and seen[3].keys() < seen[2].keys()
    assert all(r["n_chars"] == len(r["text"]) for r in seen[1].values())
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in corpus_pipeline.encode(spark, docs, SF).collect():
        assert list(r["ids"]) == lib.encode(seen[3][r["doc_id"]]["text"], add_special_tokens=False).ids


def test_texts_emptied_by_the_line_stage_are_one_group(spark):
    rows = [(7, ""), (3, None), (5, " \n"), (None, ""), (9, "one two three")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.drop_near_copies(spark, df, SF).collect()
    assert sorted(r["doc_id"] for r in got) == [3, 9]


def smallest(n, links):
    """The smallest of 0 to n - 1 that each reaches by links."""
    least = list(range(n))
    for _ in range(n):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


def test_the_whole_chain_against_brute_force(spark, engine, tmp_path):
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefghiklmnoprstu") for _ in range(rnd.randrange(3, 8)))
    line = lambda n=9: " ".join(word() for _ in range(n))
    pool, flow = [line() for _ in range(5)], [[word() for _ in range(70)] for _ in range(3)]

    def typo(s):
        at = rnd.randrange(len(s))
        return s[:at] + "z" + s[at + 1:]

    texts = []
    for i in range(110):
        if i % 11 == 10:
            texts.append("".join(rnd.choice("#$%=~0123456789 ") for _ in range(150)))
        elif i % 11 == 5:  # the same words, broken into lines elsewhere
            words, n = flow[i % 3], 9 + i % 13
            texts.append("\n".join(" ".join(words[k:k + n]) for k in range(0, 70, n)))
        elif i % 11 == 7 and i > 60:
            texts.append(texts[i - 44])
        else:
            own = [line() + "." for _ in range(2 + i % 4)] + ([typo(rnd.choice(pool))] if i % 3 == 0 else [])
            texts.append("\n".join(own + (["", "see http for more of this text"] if i % 4 == 0 else [])))
    rows = [(i, t, "en" if i % 5 < 3 else "de", f"s{i % 7 // 4}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 11 != 10), 0) for i in range(110)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    docs = {r[0]: r for r in rows if r[0] % 11 != 10}
    # Lines, by the edit distance of another engine.
    found = [(i, k, regex.sub(r"[^\p{L}\p{N}]+", " ", s.lower()).strip()) for i in docs for k, s in enumerate(texts[i].split("\n"))]
    found = [f for f in found if f[2]]
    engine.execute("CREATE TEMP TABLE found (n INT, norm VARCHAR)")
    engine.executemany("INSERT INTO found VALUES (?, ?)", [(at, f[2]) for at, f in enumerate(found)])
    links = engine.execute("""SELECT x.n, y.n FROM found x JOIN found y ON x.n < y.n AND
        levenshtein(x.norm, y.norm) <= floor(greatest(length(x.norm), length(y.norm)) * 0.2 + 1e-9)""").fetchall()
    gone = {found[at][:2] for at, first in enumerate(smallest(len(found), links)) if at != first}
    left = {i: "\n".join(s for k, s in enumerate(texts[i].split("\n")) if (i, k) not in gone) for i in docs}
    assert len(gone) > 40 and sum(not t.strip() for t in left.values()) > 1
    # Near copies; texts without words are one group.
    ids = sorted(left)
    sets = [{tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} for w in (left[i].split() for i in ids)]
    links = [(a, b) for a, b in combinations(range(len(ids)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    kept = [i for at, (i, first) in enumerate(zip(ids, smallest(len(ids), links), strict=True)) if at == first]
    assert len(ids) - len(kept) > 8
    # Raking, draw and encoding by hand.
    keys = [(docs[i][3], docs[i][2], "contact" if "http" in left[i] else "prose") for i in kept]
    index = [np.unique([k[m] for k in keys], return_inverse=True)[1] for m in range(3)]
    tokens = np.array([max(len(left[i].split()), 1) for i in kept], float)
    tokens /= tokens.sum()
    goal = [np.bincount(i, tokens) ** mixing.POWER for i in index]
    factor = np.ones(len(kept))
    for _ in range(300):
        for i, g in zip(index, goal, strict=True):
            factor *= (g / g.sum() / np.bincount(i, tokens * factor))[i]
    drawn = [(int(hashlib.md5(f"k{i}/mix".encode()).hexdigest()[:13], 16) + .5) / 2 ** 52 for i in kept]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: lib.encode(left[i], add_special_tokens=False).ids
            for i, x, p in zip(kept, drawn, factor / factor.max(), strict=True) if x < p}
    assert got == want and 5 < len(want) < len(kept)


def test_near_copies_and_mix_against_brute_force(spark):
    rnd = random.Random(11)
    word = lambda: rnd.choice("abcdefgh") * 2 + str(rnd.randrange(400))
    base = [[word() for _ in range(n)] for n in (4, 12, 40, 150, 300)]
    docs = []
    for i in range(120):
        words = list(rnd.choice(base)) if i % 3 else [word() for _ in range(30)]
        for _ in range(rnd.choice((0, 1, 2, 4, 6))):
            words[rnd.randrange(len(words))] = word()
        docs.append((i, " ".join(words) + (" http" if i % 4 == 0 else ""), "en" if i % 5 else "de", f"s{i % 7 // 3}"))
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    sets = [{tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} for w in (d[1].split() for d in docs)]
    least = list(range(len(docs)))
    links = [(a, b) for a, b in combinations(least, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in docs:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    kept = spark.createDataFrame(corpus_pipeline.drop_near_copies(spark, df, SF).collect(), df.schema)
    want = [d for d in docs if least[d[0]] == d[0]]
    assert sorted(map(tuple, kept.collect())) == want and 60 < len(want) < 115
    # Raking and the draw by hand.
    keys = [(d[3], d[2], "contact" if "http" in d[1] else "prose") for d in want]
    index = [np.unique([k[m] for k in keys], return_inverse=True)[1] for m in range(3)]
    tokens = np.array([len(d[1].split()) for d in want]) / sum(len(d[1].split()) for d in want)
    goal = [np.bincount(i, tokens) ** mixing.POWER for i in index]
    factor = np.ones(len(want))
    for _ in range(300):
        for i, g in zip(index, goal, strict=True):
            factor *= (g / g.sum() / np.bincount(i, tokens * factor))[i]
    drawn = [(int(hashlib.md5(f"k{d[0]}/mix".encode()).hexdigest()[:13], 16) + .5) / 2 ** 52 for d in want]
    sample = [d for d, x, p in zip(want, drawn, factor / factor.max(), strict=True) if x < p]
    assert sorted(map(tuple, corpus_pipeline.mix(spark, kept, SF).collect())) == sample and 0 < len(sample) < len(want)
