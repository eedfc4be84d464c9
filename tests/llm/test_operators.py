"""Every operator against a brute-force version, an exact round trip or held-out accuracy, with nulls, empty texts,
repeated rows, empty tables and columns of clashing names."""

import datetime
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import (decontaminate, html_main, language_id, mixing, pseudonyms, similarity_join, substring_dedup, token_store,
                            url_rules, winnowing)
from marketlens.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, taken long"


def frame(spark, rows):
    """Documents with columns that clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "a", 7, 7) for i, t in rows], SCHEMA)


def texts(seed, n, alphabet="ab", longest=40):
    r = random.Random(seed)
    return [(r.choice([None, *range(9)]), r.choice([None, "", " ".join(r.choice(alphabet) for _ in range(r.randrange(longest)))])) for _ in range(n)]


def page(article, nav="Home About", n=0):
    return (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href='/'>{nav}</a></nav><!-- {n} -->"
            f"<div class='ad'>Buy {n}</div><article><h1>Head</h1>{article}<div>Read more here</div></article>"
            "<div id='comments'><p>First!</p></div><form><input></form><footer>&copy; x</footer>")


def test_main_text(spark):
    rows = [(k, f"http://Site.org/{k}", page(f"<p>One&amp;{k} <b>bold\n text<br>x<p>Two", n=k)) for k in range(6)]
    rows += [(90, "http://lone.org/", page("<p>alone</p>")), (91, None, None), (92, "u", ""), (93, "http://lone.org/", "<p>cut &amp; <a hre")]
    t = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in html_main.extract_main_text(t).collect()}
    assert all(got[k] == f"Head\nOne&{k} bold text x\nTwo" for k in range(6))   # the div recurs on the site's pages
    assert got[90] == "Head\nalone\nRead more here"                             # one page shows no template
    assert (got[91], got[92], got[93]) == ("", "", "cut &")
    joined = {r["page_id"]: r["text"] for r in html_main.extract_main_text(t, broadcast_keys=0).collect()}
    assert joined == got
    assert html_main.extract_main_text(t.where("false")).count() == 0


def test_pseudonyms_are_valid_linked_and_reversible(spark):
    text = ("a +1 (526) 555-9022 4035065943088454 30.151.72.215 2024-02-29 31/12/1999 123-45-6789 DE89370400440532013000 x.12@mail.example.com "
            "4035065943088454 but 4111111111111112 999.1.1.1 2023-02-29 000-12-3456 stay")
    got = {r["doc_id"]: r for r in pseudonyms.pseudonymise(frame(spark, [(1, text), (2, None), (3, ""), (4, "plain text"), (5, text)]), "k").collect()}
    old, new = text.split(), got[1]["text"].split()
    assert len(old) == len(new) and got[1]["n_values"] == 9 and got[5]["text"] == got[1]["text"]
    assert new[4] == new[11] != old[4] and new[12:] == old[12:] and new[0] == "a"
    digits = [int(c) for c in new[4]]
    assert sum(d if i % 2 == len(digits) % 2 - 1 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(digits)) % 10 == 0 or \
        sum((2 * d - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(digits[::-1])) % 10 == 0
    assert datetime.date.fromisoformat(new[6]) and all(int(x) < 256 for x in new[5].split("."))
    assert int("".join(str(int(c, 36)) for c in new[9][4:] + new[9][:4])) % 97 == 1
    assert (got[2]["text"], got[3]["text"], got[4]["text"]) == (None, "", "plain text")
    whole = spark.range(898 * 11).select(pseudonyms.feistel(F.col("id"), F.lit(898), F.lit(11), "k", F.lit("t")).alias("y"))
    assert whole.distinct().count() == 898 * 11 and whole.agg(F.max("y")).first()[0] == 898 * 11 - 1


def test_the_key_stands_in_no_plan(spark, tmp_path, capsys):
    docs = frame(spark, [(1, "call (526) 555-9022 or 4035065943088454"), (1, "call (526) 555-9022"), (None, "x 30.151.72.215 " * 5_000)])
    table = pseudonyms.make_key(spark, str(tmp_path / "key"))
    key = table.first()["key"]
    hidden, plain = pseudonyms.pseudonymise(docs, table), pseudonyms.pseudonymise(docs, key)
    assert sorted(map(tuple, hidden.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    hidden.explain("extended")
    assert key not in capsys.readouterr().out and pseudonyms.make_key(spark, str(tmp_path / "key")).first()["key"] == key
    assert pseudonyms.pseudonymise(docs.where("false"), table).count() == 0 and len(key) == 64


def test_telephone_numbers_of_any_area_are_replaced(spark):
    forms = ["+1 ({:03d}) {:03d}-7713", "1-{:03d}-{:03d}-0000", "({:03d}) {:03d} 0042", "{:03d}.{:03d}.9999"]
    numbers = [f.format(area, (area * 7 + 17) % 1000) for area in [*range(200), 526, 999] for f in forms]
    text = "call " + " or ".join(numbers) + " now"
    got = pseudonyms.pseudonymise(frame(spark, [(1, text)]), "k").first()
    new = got["text"][5:-4].split(" or ")
    assert got["n_values"] == len(numbers) and got["text"][:5] + got["text"][-4:] == "call  now"
    shape = lambda t: "".join("d" if c.isdigit() else c for c in t)
    assert [shape(t) for t in new] == [shape(t) for t in numbers] and all(a != b for a, b in zip(numbers, new, strict=True))
    assert all(a.startswith("+1 (") == b.startswith("+1 (") for a, b in zip(numbers, new, strict=True))
    assert len({t[-12:] for t in new if shape(t) == "ddd.ddd.dddd"}) == 202     # a permutation: no two numbers meet
    assert pseudonyms.pseudonymise(frame(spark, [(1, got["text"])]), "k").first()["n_values"] == len(numbers)


@pytest.mark.parametrize("limit", [10, 1 << 20])
def test_leaks_match_brute_force(spark, limit):
    r = random.Random(4)
    items = [(k, " ".join(r.choice("ab") for _ in range(r.choice([0, 2, 5, 9])))) for k in range(12)] + [(None, "q"), (3, None), ("3", "A b,a")]
    docs = texts(5, 60) + [(9, "x" * 50 + " Q. é q"), (10, "ab " * 3000)]
    bench = spark.createDataFrame([(None if i is None else str(i), t) for i, t in items], "item_id string, text string")
    got = decontaminate.leak_report(decontaminate.find_leaks(frame(spark, docs), bench, 5, block_bytes=limit)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(decontaminate.brute_force(docs, items, 5), key=str)
    assert decontaminate.find_leaks(frame(spark, docs).where("false"), bench).count() == 0
    clean = decontaminate.leak_report(decontaminate.find_leaks(frame(spark, docs), bench.where("false")))
    assert clean.where("contaminated").count() == 0


def test_mix_reaches_targets(spark):
    r = random.Random(1)
    rows = [(k, "w " * r.choice([0, 1, 9, 40, 300]), r.choice(["b", "a", "é", None, "c"])) for k in range(900)] + [(901, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1))
    got = mixing.mix(docs).collect()
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect())) == sorted(map(tuple, got)) and len(got) == 901
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    target, left = {}, dict(zip(names, (3, 1, 2) * 2, strict=False))
    total = 1.5 * sum(size.values())
    while left:                                              # the rule, word for word: reshare what is above the limit
        share = {s: total * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if share[s] > 2 * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * size[s]
            total -= target[s]
            del left[s]
    for s in names:
        own = [x for x in got if x["source"] == s]
        assert own[0]["source_size"] == size[s] and abs(own[0]["target"] - target[s]) < 1e-6
        assert abs(sum(x["taken"] for x in own) - target[s]) <= 150 and all(   # half of the longest document
            0 <= x["taken"] <= 2 * x["size"] for x in own)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(x["repeats"] for x in got)
    assert mixing.mix(docs.where("false")).count() == 0


def test_flow_shares_overlapping_documents():
    flow = mixing.plan_flow({("a",): 10.0, ("a", "b"): 10.0, ("b",): 2.0}, {"a": 12.0, "b": 14.0}, 2)
    used = {p: sum(f.values()) for p, f in flow.items()}
    assert all(abs(sum(f.get(s, 0) for f in flow.values()) - q) < 1e-6 for s, q in (("a", 12), ("b", 14)))
    assert used[("a",)] >= 10 and used[("a", "b")] >= 10 and used[("b",)] >= 2       # nothing is repeated while words are unused
    assert abs(sum(used.values()) - 26) < 1e-6 and used[("a",)] <= 20 and used[("a", "b")] <= 20 and used[("b",)] <= 4


def test_repeats_match_brute_force(spark):
    docs = texts(7, 80)
    got = substring_dedup.remove_repeats(frame(spark, docs), 5, chunk_bytes=300, part_hashes=20, group_suffixes=6).collect()
    assert sorted(map(tuple, got), key=str) == sorted(substring_dedup.brute_force(docs, 5), key=str)
    assert substring_dedup.remove_repeats(frame(spark, docs).where("false")).count() == 0


def test_url_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/a.b", "block")]
    urls = ["http://EXAMPLE.org/es/1?x", "https://a.example.org/en", "x://notexample.org/es/", "http://b.com/a.bc", "http://b.com/axb", "http://c.com",
            "http://free-bets.com/x", "nourl", None, "http://org?/", "http://a.example.org/es/2", "http://a.example.org/es/2"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    table = url_rules.rule_table(spark, [url_rules.list_rule(*x) for x in rules] + [url_rules.word_rule("bets")])
    want = {0: ("example.org/es/", "block"), 1: ("org/", "allow"), 2: ("org/", "allow"), 3: ("com/a.b", "block"), 4: (None, "allow"), 5: (None, "allow"),
            6: (None, "block"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: ("example.org/es/", "block"), 11: ("example.org/es/", "block")}
    for limit in (0, 100):
        got = url_rules.judge_urls(pages, table, broadcast_rules=limit)
        assert got.count() == 11
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.filter_urls(pages, table).collect()}
    assert got == want
    assert url_rules.filter_urls(pages.where("false"), table).count() == 0


def test_token_store_round_trip(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tool = Tokenizer.from_file(path)
    r = random.Random(2)
    letters = [*"abzAB019.,;:'!?-<|>\"$&", " ", " ", "\n", "\t", "é", "İ", "ß", "Σ", "中", "\u0308", "½", "\u00a0", "\x1f", "'s"]
    docs = [(k * 3 % 101, "".join(r.choice(letters) for _ in range(r.randrange(60)))) for k in range(300)] + [(None, "x <|endoftext|>, y"), (500, ""), (501, None)]
    where = token_store.write_store(frame(spark, docs), token_store.new_store_path(spark), path, 2)
    got = [(x["doc_id"], x["start"], np.frombuffer(x["ids"], "<u4").tolist()) for x in token_store.read_store(spark, where).collect()]
    got.sort(key=lambda x: x[1])
    assert [x[1] for x in got] == np.cumsum([0] + [len(x[2]) for x in got])[:-1].tolist()
    assert [x[0] for x in got] == sorted((i for i, _ in docs), key=lambda i: (i is not None, i))
    want = sorted(((i, tool.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in docs), key=str)
    assert sorted(((i, ids) for i, _, ids in got), key=str) == want
    assert {x["doc_id"] for x in token_store.read_documents(spark, where, [500, 501]).collect()} == {500, 501}
    empty = token_store.write_store(frame(spark, docs).where("false"), token_store.new_store_path(spark), path, 2)
    assert token_store.read_store(spark, empty).count() == 0


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    known = language_id.collect_prototypes(language_id.learn_prototypes(docs.where(~held)))
    got = language_id.identify(docs.where(held), known).join(docs, "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()
    odd = language_id.identify(frame(spark, [(1, None), (2, ""), (3, "12 !?"), (4, "The"), (4, "The")]), known).collect()
    assert [r["lang_pred"] for r in odd][:3] == ["und"] * 3 and odd[3] == odd[4] and all(0 <= r["score"] <= 1 for r in odd)
    assert language_id.identify(frame(spark, [(1, "word")]), {}).first()["lang_pred"] == "und"
    assert language_id.collect_prototypes(language_id.learn_prototypes(docs.where("false"))) == {}


@pytest.mark.parametrize("size,percent", [(2, 80), (4, 85)])
def test_similar_groups_match_brute_force(spark, size, percent):
    r = random.Random(9)
    base = [[r.choice("abcdefghijkl") for _ in range(r.choice([1, 2, 6, 14, 25, 60]))] for _ in range(20)]
    docs = [(None, None), (1, ""), (3, "A b"), (4, "a  B")]
    for k in range(150):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2])):
            w[r.randrange(len(w))] = r.choice("abcXYZ")
        docs.append((r.choice([None, *range(99)]) if k % 10 == 0 else 1000 + k, " ".join(w)))
    got = similarity_join.similar_groups(frame(spark, docs), size, percent, chunk_bytes=2000, part_hashes=100, block=3, task_bytes=500).collect()
    assert sorted(map(tuple, got), key=str) == sorted(similarity_join.brute_force(docs, size, percent), key=str)


def hashes(values):
    return np.sort(np.array(values, np.uint64)).tobytes()


def test_a_task_of_a_large_family_holds_two_blocks(spark):
    """A family of 300 strangers (10 blocks), 150 families of two."""
    names = [f"{k:04d}".encode() for k in range(600)]
    sets = spark.createDataFrame([(n, 4, hashes(range(4 * k, 4 * k + 4))) for k, n in enumerate(names)], "name binary, n int, hashes binary")
    rows = [(1, k, n) for k, n in enumerate(names[:300])] + [(2 + k // 2, k, n) for k, n in enumerate(names[300:])]
    lists = spark.createDataFrame(rows, "token long, id long, name binary")
    cells, links = similarity_join._cells(sets, lists, 80, 30, 640)
    tasks = {}
    for c in cells.collect():
        tasks.setdefault((c["bucket"], c["family"], c["lo"], c["hi"]), []).append(c)
    family = [v for k, v in tasks.items() if k[1] is not None]
    small = [v for k, v in tasks.items() if k[1] is None]
    assert links.count() == 0 and len(family) == 55 + 10 and max(map(len, family)) < 4 * 30     # 10 blocks, and the pivot's own with each
    assert sum(map(len, family)) == 299 * 11 + 10                                                 # no set missing
    assert sum(map(len, small)) == 300 and 5 < len(small) <= 15 and max(map(len, small)) < 100


def test_members_that_link_with_the_pivot_are_not_compared(spark):
    """1,000 near copies of one set and 5 strangers in its lists: the copies meet the strangers only."""
    r = random.Random(8)
    base = list(range(1_000, 1_050))
    own = [sorted([*base[:-2], 10_000 + 2 * k, 10_001 + 2 * k]) if k else base for k in range(1_000)] + [sorted([1_000, *range(50_000 + 60 * k, 50_049 + 60 * k)])
                                                                                                         for k in range(5)]
    names = [f"{k:05d}".encode() for k in range(len(own))]
    sets = spark.createDataFrame([(n, 50, hashes(x)) for n, x in zip(names, own)], "name binary, n int, hashes binary")
    rows = [(1_000, k, n) for k, n in enumerate(names)]
    r.shuffle(rows)
    lists = spark.createDataFrame(rows, "token long, id long, name binary")
    cells, links = similarity_join._cells(sets, lists, 80, 100, 640)
    assert links.count() == 999 and cells.count() == 5 * 11 + 1_000                               # one block of strangers, ten of copies
    found = similarity_join._heavy_links(sets, lists, 80, 100, 640).distinct().collect()
    roots = components(spark.createDataFrame(found)).groupBy("root").count().collect()
    assert [x["count"] for x in roots] == [1_000]
    for limit in (0, 1 << 30):                                                                    # pivots joined, and broadcast
        similarity_join.PIVOT_BYTES, before = limit, similarity_join.PIVOT_BYTES
        try:
            assert similarity_join._cells(sets, lists, 80, 100, 640)[1].count() == 999
        finally:
            similarity_join.PIVOT_BYTES = before


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 30)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in range(1, 31)} == {1} and {got[k] for k in range(100, 130)} == {100}


def test_winnowing(spark):
    r = random.Random(3)
    for _ in range(200):
        t, g, w = "".join(r.choice("ab") for _ in range(r.randrange(1, 60))), r.choice([1, 3]), r.choice([1, 4, 9])
        h, at = winnowing.gram_hashes(np.frombuffer(t.encode("utf-32-le"), np.uint32), g).tolist(), winnowing.winnow(t, g, w)[1].tolist()
        n = min(w, len(h))
        assert at == sorted({max(j for j in range(i, i + n) if h[j] == min(h[i:i + n])) for i in range(len(h) - n + 1)})
    docs = [(i, "".join(r.choice("abcdé ") for _ in range(r.choice([0, 3, 200, 400])))) for i in range(40)] + [(77, None)]
    got = {x["doc_id"]: x for x in winnowing.next_document_report(frame(spark, docs), range_bytes=500).collect()}
    order = sorted(docs, reverse=True, key=lambda x: x[0])
    for k, (i, t) in enumerate(order):
        edited = winnowing.edited_text(t or "", order[(k + 1) % len(order)][1] or "")
        assert got[i]["n_chars"] == len(t or "") and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i]["near_edited"] == 1.0) if len(t or "") < 3 else (0 <= got[i]["near_edited"] <= 1)
        for text, print_, places in ((t or "", "fingerprint", "positions"), (edited, "edited_fingerprint", "edited_positions")):
            hashes, at = winnowing.winnow(text)
            assert got[i][places] == at.tolist() and got[i][print_] == hashes.astype(">u4").tobytes().hex()
    assert winnowing.next_document_report(frame(spark, [(1, "abc")])).first()["near_next"] == 1.0
    assert winnowing.next_document_report(frame(spark, docs).where("false")).count() == 0


def test_fingerprints_are_dense_enough_for_short_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy(F.desc("doc_id")).limit(1000)
    every = [r["text"] or "" for r in docs.select("text").collect()]
    likeness = lambda a, b, w: winnowing.likeness(winnowing.winnow(a, window=w)[0], winnowing.winnow(b, window=w)[0])
    for low, high, most in ((30, 100, 0.1), (100, 200, 0.05), (200, 400, 0.03)):
        pairs = [(t, winnowing.edited_text(t, every[(k + 1) % len(every)])) for k, t in enumerate(every) if low <= len(t) < high]
        got = [likeness(a, b, winnowing.WINDOW) for a, b in pairs]
        errors = [abs(x - likeness(a, b, 1)) for x, (a, b) in zip(got, pairs, strict=True)]    # a window of 1 keeps all grams
        assert len(pairs) > 9 and min(got) > 0 and sum(errors) / len(errors) < most
    r = random.Random(5)
    for _ in range(300):
        run, a, b, c, d = ("".join(r.choice("abcdefgh") for _ in range(n)) for n in (23, *(r.randrange(50) for _ in range(4))))
        assert likeness(a + run + b, c + run + d, winnowing.WINDOW) > 0


def test_pipeline_drops_languages_that_were_not_learned(spark):
    import corpus_pipeline
    r = random.Random(6)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    word = lambda low, high: "".join(chr(r.randrange(low, high)) for _ in range(r.randrange(2, 9)))
    odd = [(-1 - k, " ".join(word(*script) for _ in range(n)))
           for k, (script, n) in enumerate([(s, n) for s in ((0x3b1, 0x3ca), (0x430, 0x450), (0x4e00, 0x5e00)) for n in (20, 200)] * 20)]
    odd.append((-900, "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью"))
    latin = [(-1000 - k, " ".join(word(97, 123) for _ in range(200))) for k in range(50)]
    rows = spark.createDataFrame([(i, t, None, "x", len(t)) for i, t in odd + latin], docs.schema)
    kept = {x[0] for x in corpus_pipeline.identify_languages(spark, docs.unionByName(rows), "").select("doc_id").collect()}
    assert not kept & {i for i, _ in odd} and len(kept & {i for i, _ in latin}) <= 5
    clean = {x["doc_id"] for x in docs.where("lang IS NOT NULL").collect() if any(c.isalpha() for c in x["text"] or "")}
    assert clean <= kept


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.001").checkpoint()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    last = corpus_pipeline.STAGES[4][1](spark, docs, "/root/testdata/sf0.001").collect()
    assert 0 < docs.select("doc_id").distinct().count() < before and len(last) == docs.count()
    assert zlib.crc32(b"") == 0 and max(r["start"] for r in last) > 0
