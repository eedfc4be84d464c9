"""The pipeline's stages on nulls, repeated rows, rows of one id, empty tables and columns of clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from marketlens.llm import language_id, similarity_join

SF = "/root/testdata/sf0.001"
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, name int, component_id int, _row int, size string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "r", 1, 2, 3, "z") for i, t, s in rows], DDL)


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("the of and to in is that for it as was with be by on not he his are this") + rng.choice("abcdefgh") * 2 for _ in range(n))


def test_near_duplicate_stage_matches_brute_force(spark):
    import corpus_pipeline
    rng = random.Random(3)
    base = [words(k, rng.choice([1, 3, 12, 60, 90])) for k in range(12)]
    rows = [(5, None, "a"), (6, "", "a"), (6, "", "a"), (None, None, "b")]
    for k in range(160):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice("xyz") * 4
        rows.append((rng.choice([None, *range(60)]), " ".join(w), rng.choice("ab")))
    rows += rows[20:40]                                                  # repeated rows
    kept = corpus_pipeline.drop_near_duplicates(spark, docs_of(spark, rows), SF)
    assert kept.columns == docs_of(spark, rows[:1]).columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    distinct = sorted({(i, t) for i, t, _ in rows}, key=str)
    group = {d: g for d, (_, _, g) in zip(distinct, similarity_join.brute_force([(k, t) for k, (_, t) in enumerate(distinct)], 5, 80), strict=True)}
    members = {}
    for d, g in group.items():
        members.setdefault(g, []).append(d)
    assert len(got) == len(set(got)) == len(members)                      # one row of each group, and of each repeated row
    for d in got:
        least = min((i is None, i or 0) for i, _ in members[group[d]])
        assert (d[0] is None, d[0] or 0) == least


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_and_take_odd_rows(spark, stage):
    import corpus_pipeline
    rows = [(None, words(1, 40), None), (1, None, "a"), (2, "", "a"), (3, words(2, 40), "b"), (3, words(2, 40), "b"), (3, words(3, 50), "b"),
            (4, words(4, 20_000), "c"), (5, "12 !?", "c")]
    docs = docs_of(spark, rows)
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs, SF)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert set(got) <= {(i, t) for i, t, _ in rows}
    if name == "language_id":
        assert (1, None) not in got and (2, "") not in got and (5, "12 !?") not in got and got.count((3, words(2, 40))) == 2
    if name == "near_duplicates":
        assert got.count((3, words(2, 40))) == 1 and len(got) == 7
    empty = run(spark, docs.where("false"), SF)
    assert empty.columns == docs.columns and empty.count() == 0


def test_last_stage_of_odd_rows(spark):
    import corpus_pipeline
    pytest.importorskip("public_tokenizers")
    run = corpus_pipeline.STAGES[4][1]
    rows = [(None, "a b", None), (1, None, "a"), (1, None, "a"), (2, "", "a"), (3, words(5, 30_000), "b")]
    got = sorted(run(spark, docs_of(spark, rows), SF).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 1, 2, 3] and [r["n_tokens"] for r in got][:4] == [3, 1, 1, 1]
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(5)]
    assert run(spark, docs_of(spark, rows).where("false"), SF).count() == 0


def plain_languages(train, tests, size, seed=language_id.SEED):
    """Trigram profiles by dictionaries: the same vectors, bundled and compared without numpy's blocks."""
    import numpy as np

    def letters(c):
        return np.random.default_rng([seed, ord(c) if c != " " else 0]).integers(0, 2, size) * 2 - 1

    def profile(text):
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
        out = np.zeros(size)
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            out += np.roll(letters(a), 2) * np.roll(letters(b), 1) * letters(c)
        return out

    known = {}
    for lang, text in train:
        if lang is not None and text is not None:
            known[lang] = known.get(lang, np.zeros(size)) + profile(text)
    out = []
    for t in tests:
        p = profile(t)
        if not any(c.isalpha() for c in t or ""):
            out.append(("und", 0.0))
            continue
        cos = [(float(p @ v / np.linalg.norm(p) / np.linalg.norm(v)), k) for k, v in sorted(known.items())]
        best = max(c for c, _ in cos)
        out.append((next(k for c, k in cos if c == best), max(best, 0.0)))
    return out


def test_language_id_equals_plain_profiles(spark):
    rng = random.Random(2)
    alphabet = {"a": "abcde é", "b": "bcdfg ü", "c": "xyzß ñ"}
    text = lambda k: "".join(rng.choice(alphabet[k] + "   1,\n") for _ in range(rng.randint(0, 80)))
    train = [(k, text(k)) for k in "abc" for _ in range(6)] + [(None, "abc"), ("a", None)]
    tests = [text(rng.choice("abc")) for _ in range(40)] + [None, "", "1 2", "É", "abc abc"]
    known = language_id.collect_prototypes(language_id.learn_prototypes(spark.createDataFrame(train, "lang string, text string"), size=64))
    df = spark.createDataFrame(list(enumerate(tests)), "doc_id int, text string").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(df, known).collect()}
    for k, (lang, score) in enumerate(plain_languages(train, tests, 64)):
        assert got[k][0] == lang and abs(got[k][1] - score) < 1e-6, tests[k]
    assert language_id.identify(df.where("false"), known).count() == 0
    tied = {"q": [1.0] * 64, "p": [1.0] * 64}
    assert language_id.identify(df.where("doc_id = 44"), tied).first()["lang_pred"] == "p"          # ties go to the smaller name
