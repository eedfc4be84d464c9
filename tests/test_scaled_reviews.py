"""Steps over review texts that had to grow no faster than their input: brute force on odd rows, and what their plans may hold."""

import datetime as dt
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlens import session
from marketlens.plans import reviews, sentiment
from marketlens.sources.tables import SCHEMAS, Tables


def made(spark, **rows):
    t = Tables(spark, "/nowhere")
    for name in ("nation", "region", *rows):
        t._cache[name] = spark.createDataFrame(rows.get(name, []), SCHEMAS[name])
    return t


def test_ngrams_copy_no_lists(spark):
    words = "alpha beta gamma alpha beta gamma delta".split()
    docs = [(5, " ".join(words), "xx", None, 1), (6, "solo", "xx", None, 1), (7, "", "xx", None, 1), (8, None, "xx", None, 1)]
    t = made(spark, documents=docs, labels=[], events=[(11, dt.datetime(2000, 1, 1), 1, "a", 1.0, "")], part=[(1, "a", "b", "ECONOMY", 2, 10.0)],
             lineitem=[(d[0], 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", dt.datetime(2000, 1, 1)) for d in docs])
    grams = reviews.top_ngrams(t)
    want = {}
    for n in (1, 2, 3):
        for text in ("alpha beta gamma alpha beta gamma delta", "solo"):
            w = text.split()
            for i in range(len(w) - n + 1):
                side = "negative" if 1 + (5 if len(w) > 1 else 6) % 5 <= 2 else "positive"
                want[side, n, " ".join(w[i:i + n])] = want.get((side, n, " ".join(w[i:i + n])), 0) + 1
    assert {(r["sentiment"], r["n"], r["ngram"]): r["count"] for r in grams.collect()} == want
    assert "slice(" not in grams._jdf.queryExecution().optimizedPlan().toString()


def test_review_dates_come_from_two_events(spark):
    at = [dt.datetime(2000, 1, 1 + i) for i in range(9)]
    t = made(spark, documents=[(1, "a", "en", "s", 1), (-2, "b", "en", "s", 1), (9, "c", "en", "s", 1), (None, "d", "en", "s", 1)], labels=[(1, 1, 0)],
             events=[(2, at[0], 1, "a", 1.0, ""), (3, at[1], 1, "a", 1.0, ""), (-4, at[2], 1, "a", 1.0, ""), (-3, at[3], 1, "a", 1.0, ""),
                     (None, at[4], 1, "a", 1.0, ""), (0, at[5], 1, "a", 1.0, "")])
    got = {r["review_comment_message"]: (r["review_creation_date"], r["review_answer_timestamp"]) for r in reviews.V.reviews(t).collect()}
    assert got == {"a": (at[0], at[1]), "b": (at[2], at[3]), "c": (None, None), "d": (None, None)}


def test_heavy_text_steps_are_dealt(spark):
    t = made(spark, documents=[], labels=[], events=[], part=[], lineitem=[])
    plan = reviews.clean_reviews(t)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan


def odd_reviews(spark):
    """Ids that come twice, texts without words, null texts and ids, documents without lines, labels that come twice."""
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["alpha", "Beta", "gamma!!", "delta", "walking", "cities", f"w{i}"]) for _ in range(rng.randint(1, 12))), rng.choice(["xx", "en", None]), None, 1)
            for i in range(60)]
    docs += [(3, "beta beta cats", "en", None, 1), (3, "alpha ??", "xx", None, 1), (60, "", "en", None, 1), (61, None, "en", None, 1), (None, "alpha", "en", None, 1), (99, "alpha", "en", None, 1)]
    ids = {d[0] for d in docs if d[0] is not None} - {99}
    lines = [(i, 1, 1, n, 1.0, 1.0, 0.0, 0.0, "N", "O", dt.datetime(2000, 1, 1)) for i in ids for n in (1, 2)] + [(500, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", None)]
    labels = [(i, i % 2, 0) for i in range(0, 62)] + [(4, 1, 0), (5, None, 0)]
    t = made(spark, documents=docs, labels=labels, events=[(10, dt.datetime(2000, 1, 1), 1, "a", 1.0, ""), (10, dt.datetime(2000, 1, 1), 1, "a", 1.0, "")],
             part=[(1, "a", "b", "ECONOMY", 2, 10.0)], lineitem=lines)
    twice = {4: 2, 5: 4}                                     # two labels each, and two events of 5
    return t, [d for d in docs if d[0] in ids and d[1] is not None for _ in range(twice.get(d[0], 1))]


def test_features_of_odd_rows(spark):
    t, rows = odd_reviews(spark)
    r = sentiment.prepare(t)
    assert sorted(x["review_id"] for x in r.rows.collect()) == sorted(d[0] for d in rows)
    label = {i: float(1 - i % 2) for i in range(62)} | {4: 0.0}
    assert all(x["label"] == label[x["review_id"]] for x in r.rows.collect())
    stop = set(reviews.TX.default_stopwords("english"))
    counts = {}
    for i, text, lang, *_ in rows:
        for w in re.findall(r"[a-z]+|[^a-z0-9\s]+", text.lower()):
            if lang != "en" or w not in stop:
                counts[i, w] = counts.get((i, w), 0) + 1
    held = {i for i in label if hashlib.sha256(str(i).encode()).hexdigest()[:2] < sentiment.HELD_OUT_BELOW}
    n = sum(d[0] not in held for d in rows)
    df = {w: sum(x == w and i not in held for i, x in counts) for w in {x for _, x in counts}}
    words = {w for w, k in df.items() if sentiment.MIN_DF <= k <= sentiment.MAX_DF * n}
    want = {(i, w): k * (math.log((1 + n) / (1 + df[w])) + 1) for (i, w), k in counts.items() if w in words}
    norm = {}
    for (i, _), x in want.items():
        norm[i] = norm.get(i, 0.0) + x * x
    got = {(x["review_id"], x["term"]): x["tfidf"] for x in r.features.collect()}
    assert len(words) > 3 and set(got) == set(want) and all(abs(got[k] - want[k] / math.sqrt(norm[k[0]])) < 1e-9 for k in want)


def test_words_are_counted_where_the_texts_lie(spark, monkeypatch):
    made_, keep = [], sentiment.kept
    monkeypatch.setattr(sentiment, "kept", lambda df, *a: made_.append(df) or keep(df, *a))
    sentiment.prepare(odd_reviews(spark)[0])
    plan = made_[0]._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate explode(")]
    assert "HashAggregate" in above and "Exchange" not in above         # words don't move
    assert len(re.findall(r"Exchange hashpartitioning\([^\n]*REPARTITION", plan)) == 1      # the texts do, once


def test_stems_of_odd_rows_move_as_pieces(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "PIECE", 4)
    rng = random.Random(9)
    some = ["cats", "a b", 'q"u\\o', "dogs", "", None, "ñandú", "null", "x\ty"]
    rows = [(i % 37 if i % 11 else None, rng.choice(["en", "de", None]), [rng.choice(some) for _ in range(rng.randint(0, 11))]) for i in range(60)] + [(99, "en", None)]
    book = [("en", "cats", "cat"), ("de", "cats", "kat"), ("en", "dogs", "dog"), ("en", "dogs", "hound"), ("en", "", "empty"), (None, "cats", "no"), ("en", None, "no"),
            ("en", "null", None), ("de", "a b", "a"), ("en", "unused", "u")]
    df = spark.createDataFrame(rows, "id int, lang string, toks array<string>")
    got = sentiment.stem_tokens(df, spark.createDataFrame(book, "lang string, token string, stem string"), "id")
    stems, pieces = {}, {}
    for lang, token, stem in book:
        if lang and token is not None:
            stems.setdefault((lang, token), []).append(token if stem is None else stem)
    for key, lang, toks in rows:
        pieces.setdefault(key, {}).setdefault(0, [])
        for at, w in enumerate(toks or []):
            if w is not None:
                pieces[key].setdefault(at // 4, []).extend((at % 4, s) for s in stems.get((lang, w), [w]))
    want = {k: [w for p in sorted(of) for _, w in sorted(of[p])] for k, of in pieces.items()}
    assert {r["id"]: r["stems"] for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Generate posexplode")]         # single words are never dealt to be put together
    labels = session.block_labels(spark)
    parts = spark.createDataFrame([(v,) for v in labels], "v int").select(F.pmod(F.hash("v"), F.lit(len(labels))).alias("p")).distinct().count()
    assert len(set(labels)) == len(labels) and parts == len(labels) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize(("k", "max_n", "first"), [(3, 3, 4), (2, 4, 1), (4, 3, 1_000), (30, 2, 6), (3, 1, 2)])
def test_top_ngrams_equal_counting_all(spark, k, max_n, first):
    rng = random.Random(k)
    line = ["qx", "qy", "qz"]                                # words that are rare but for one line
    rows = []
    for i in range(120):
        side = "negative" if i % 3 else "positive"
        toks = [f"w{min(int(rng.expovariate(0.2)), 40)}" for _ in range(rng.randint(0, 20))]
        rows.append((side, toks + (line if i % 4 == 0 else []) + (["äö", "aa"] if i % 2 else [])))
    rows += [("negative", ["uu"]), ("positive", [])]
    counts = {}
    for side, toks in rows:
        for n in range(1, max_n + 1):
            for i in range(len(toks) - n + 1):
                key = (side, n, " ".join(toks[i:i + n]))
                counts[key] = counts.get(key, 0) + 1
    want = set()
    for side, n in {(s, n) for s, n, _ in counts}:
        best = sorted(((-c, g.encode()) for (s, m, g), c in counts.items() if (s, m) == (side, n)))[:k]
        want |= {(side, n, g.decode(), -c, i + 1) for i, (c, g) in enumerate(best)}
    df = spark.createDataFrame(rows, "sentiment string, toks array<string>")
    got = reviews.top_ngrams_of(df, k, max_n, first)
    assert got.columns == ["sentiment", "n", "ngram", "count", "rank"] and {tuple(r) for r in got.collect()} == want
    assert reviews.top_ngrams_of(df.where("size(toks) = 0"), k, max_n, first).count() == 0


def test_rare_ngrams_are_not_counted(spark, monkeypatch):
    rng = random.Random(2)
    rows = [("negative", [w for _ in range(20) for w in (rng.choice(["aa", "bb", "cc"]), rng.choice(["dd", "ee"]), f"w{rng.randint(0, 10**6)}")]) for _ in range(80)]
    written, keep = [], reviews.kept
    monkeypatch.setattr(reviews, "kept", lambda df, *a: written.append(keep(df, *a)) or written[-1])
    got = reviews.top_ngrams_of(spark.createDataFrame(rows, "sentiment string, toks array<string>"), 5, 2, first=5)
    assert got.count() == 10 and got.where("n = 2 AND count > 200").count() == 5
    every = len({tuple(toks[i:i + 2]) for _, toks in rows for i in range(len(toks) - 1)})
    assert every > 2_000 and sum(x.where("n = 2").count() for x in written) < 50
