"""The training-data operators against brute force and on the edge cases that their docstrings define."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from versegraph.llm import canonical, confusables, leaks, noise, packing, quality, spans

D = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def brute_spans(texts, least):
    """Maximal runs of characters in passages of ``least`` that another key has too."""
    where = {}
    for k, t in texts.items():
        for i in range(len(t or "") - least + 1):
            where.setdefault(t[i : i + least], set()).add(k)
    out = []
    for k, t in texts.items():
        hit = np.zeros(len(t or ""), bool)
        for i in range(len(t or "") - least + 1):
            if len(where[t[i : i + least]]) > 1:
                hit[i : i + least] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        out += [(k, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
    return sorted(out)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh é\U0001f600") for _ in range(rng.randint(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(30)[: rng.randint(60, 140)] for _ in range(6)]
    out = {k: text(rng.randint(0, 20)) + "".join(rng.choice(shared)[rng.randint(0, 30) :] + text(rng.randint(0, 6)) for _ in range(rng.randint(0, 3))) for k in range(1, 61)}
    out |= {70: None, 71: "", 72: "x" * 80, 73: "x" * 500, 74: "y" * 79, 75: "y" * 79, 76: shared[0] * 40, 77: "z" * 300}
    return out


def test_spans_match_brute_force(spark, passages, monkeypatch):
    table = [(k, t, "clash", 0) for k, t in passages.items()] + [(1, passages[1], "again", 1)]
    df = spark.createDataFrame(table, "verse_id long, text string, cut string, h long")
    want = brute_spans(passages, 80)
    assert rows(spans.shared_spans(df, "verse_id", "text")) == want and len(want) > 20
    # filters that let everything pass change nothing
    monkeypatch.setattr(spans, "_passing", lambda df, column, values: df)
    assert rows(spans.shared_spans(df, "verse_id", "text")) == want
    assert rows(spans.shared_spans(df.limit(0), "verse_id", "text")) == []


def test_chunks_resist_insertions(passages):
    text = "".join(passages[k] for k in range(1, 30))
    chunks = lambda t: {t[a:b] for _, a, b in zip(*spans.Rolled([t], 80).chunks())}
    one, two = chunks(text), chunks("inserted " + text[:400] + "more" + text[400:])
    assert len(one) > 20 and len(one - two) <= 6


def test_canonical_values(spark):
    canon = spark.createDataFrame([("I Orrim", "1 Or", "First Songs", 1), ("II Orrim", "2 Or", None, 2), ("Hymns of Sarem", "HySar", "Saremite Psalter", 3), (None, None, None, 4)], "book string, abbreviation string, alt_title string, num int")
    typed = {
        "hymns of sarem": "Hymns of Sarem", "HYSAR.": "Hymns of Sarem", "Hmyns of Sarem": "Hymns of Sarem", "Hymns…": "Hymns of Sarem", "Ｈｙｍｎｓ of Sarem": "Hymns of Sarem",
        "Book of Hymns of Sarem (x)": "Hymns of Sarem", "Saremite Psaltr": "Hymns of Sarem", "2nd Orrim": "II Orrim", "Orrim, Second Book of": "II Orrim", "lI Orrim": "II Orrim",
        "Second Orrm": "II Orrim", "1Orrim": "I Orrim", "First Songs": "I Orrim", "Orrim": "UNMATCHED", "III Orrim": "UNMATCHED", "": "UNMATCHED", " ": "UNMATCHED", "?": "UNMATCHED", "x" * 5000: "UNMATCHED", "it's \\ {a}": "UNMATCHED",
    }
    values = spark.createDataFrame([(v, "clash") for v in [*typed, *typed, None]], "value string, book string")
    assert {r.value: r.book for r in canonical.mapping(values, canon).collect()} == typed
    assert {r.book for r in canonical.mapping(values, canon.limit(0)).collect()} == {"UNMATCHED"}
    assert canonical.mapping(values.limit(0), canon).count() == 0


def test_canonical_without_broadcast(spark, monkeypatch):
    canon = spark.createDataFrame([("Hymns of Sarem", "HySar", None)], "book string, abbreviation string, alt_title string")
    monkeypatch.setattr(canonical, "MOST_ROWS", 0)
    values = spark.createDataFrame([("Hymsn of Sarem",), ("Hymns",), ("none at all",)], "value string")
    assert {r.value: r.book for r in canonical.mapping(values, canon).collect()} == {"Hymsn of Sarem": "Hymns of Sarem", "Hymns": "Hymns of Sarem", "none at all": "UNMATCHED"}


def test_confusable_forms():
    same = {
        "a b": "a b", "Ａb，": "Ab,", "é": "é", "z​ero": "zero", "но": "но", "lοck": "lock", "Сор": "Cop", "so­ft": "soft", "ﬁre": "fire", "sun‑dried": "sun-dried",
    }
    for text, want in same.items():
        assert confusables.form(text)[0] == want, text
    for text in ("so­\nft", "dwelling²", "αψχ", "аж", "café", "a—b", "", "中文", "x" * 100_000):
        assert confusables.form(text)[0] == text
    # a Latin letter inside a word that only Greek can spell becomes Greek
    assert confusables.form("ψαo")[0] == "ψαο"
    assert confusables.form("lοck")[1] == "mixed_script" and confusables.form("Сор")[1] == "whole_script"
    assert [confusables.form(t)[0] for t in ("Ⅳ 𝖡ook", "𝟙𝟚 ⅷ", "x²")] == ["IV Book", "12 viii", "x²"]


def test_confusable_pairs(spark):
    texts = [(1, "no lock"), (2, "nο lock"), (3, "no lock"), (4, "no lock"), (5, "No lock"), (6, None), (7, ""), (8, "​"), (9, ""), (1, "no lock"), (None, "no lock")]
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in texts], "id long, text string, raw int, h string")
    want = [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (7, 8), (8, 9)]
    assert rows(confusables.lookalike_pairs(df, "id", "text")) == want
    assert rows(confusables.lookalike_pairs(df.limit(0), "id", "text")) == []


@pytest.fixture(scope="module")
def cleaner():
    words = "the that mountain lamp warden carried island she said with trust trusting sun-dried fig gate gates lamps burden corner cornerstone olive quenched her".split()
    counts = {w: 1000 for w in words} | {"adonel": 50}
    return noise.Cleaner(noise.trusted_words(counts, set(words), 100_000), counts, ["Thrassians", "I Orrimund", "Hymns of Sarem"])


@pytest.mark.parametrize(
    "text, kinds, repaired",
    [
        ("she carried the is-\nland", "hyphen", "she carried the island"),
        ("she carried the is­\n land", "hyphen", "she carried the island"),
        ("the sun-\ndried fig", "", "the sun-dried fig"),
        ("the m0untain gate5", "misread", "the mountain gates"),
        ("the comerstone", "misread", "the cornerstone"),
        ("quenchecl larnp", "misread", "quenched lamp"),
        ("the rnoun-\ntain", "hyphen misread", "the mountain"),
        ("the\nTHRASSIANS 13\nlamp", "header", "the lamp"),
        ("the\n12 · HYMNS 0F SAREM\nlamp", "header", "the lamp"),
        ("the\n1 O R R I M U N D  4\nlamp", "header", "the lamp"),
        ("the\n752   I ORRIMUND\nlamp", "header page_number", "the lamp"),
        ("the\nThe Old Codex  65\nlamp", "header page_number", "the lamp"),
        ("the\n- 51 -\nlamp", "page_number", "the lamp"),
        ("the\nlxxix\nlamp", "page_number", "the lamp"),
        ("is-\n[7]\nland", "hyphen page_number", "island"),
        ("l2  the lamp", "misread", "12  the lamp"),
        ("Zorvath said ADONEL", "", "Zorvath said ADONEL"),
        ("", "", ""),
        ("thelamp", "", "the lamp"),
        ("the moun tain", "", "the mountain"),
        ("thernountainlamp", "misread", "the mountain lamp"),
    ],
)
def test_scan_noise(cleaner, text, kinds, repaired):
    got, body = cleaner.clean(text, noise.title_of("Old Codex 00-0001"))
    assert sorted(got) == kinds.split()
    assert body == repaired


def test_scan_noise_at_box_ends(cleaner):
    assert cleaner.clean("she said trust-", ahead="ing the")[0] == {"hyphen"}
    assert cleaner.clean("the sun-", ahead="dried fig")[0] == set()
    assert cleaner.clean("she said tru-")[0] == {"hyphen"}
    assert cleaner.clean("15", small=False)[0] == set() and cleaner.clean("15", small=True)[0] == {"page_number"}
    assert "misread" in cleaner.clean("l5", small=False)[0] and cleaner.clean("l5", small=True)[0] == {"page_number"}
    assert cleaner.clean("z" * 3000)[0] == set()


def test_paragraph_boundaries():
    parts = [("A starts here", False, False), ("and ends.", False, False), ("TITLE", True, False), ("New one.", False, False), ("Goes on with trust", False, False), ("ing.", False, True)]
    assert noise.boundaries(parts) == [0, 2, 3] and noise.boundaries([]) == []


def test_noise_queries_on_empty_tables(spark, tmp_path):
    for name in ("page_boxes", "verses", "word_list", "canon_books"):
        spark.read.parquet(f"{D}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert noise.found(spark, str(tmp_path)).count() == 0
    assert noise.paragraphs(spark, str(tmp_path)).count() == 0


def test_packing_plan():
    rng = random.Random(3)
    for _ in range(200):
        capacities = rng.sample([16, 32, 50, 64, 100, 128], rng.choice([1, 2, 3]))
        histogram = {rng.randint(1, max(capacities)): rng.randint(1, 40) for _ in range(rng.randint(0, 30))}
        planned, groups = packing.plan(histogram, capacities)
        fills, holds = {}, {}
        for g in groups:
            for c in range(g.first, g.first + g.count):
                assert c not in fills and g.capacity in capacities and 0 <= g.free
                fills[c] = g.capacity - g.free
        for size in histogram:
            at = 0
            for s, first, n, container, each in sorted(p for p in planned if p[0] == size):
                assert first == at
                at += n
                for k in range(n):
                    holds[container + k // each] = holds.get(container + k // each, 0) + s
            assert at == histogram[size]
        assert holds == fills
        # of one capacity no two containers could be one
        assert len(capacities) > 1 or sum(2 * f <= capacities[0] for f in fills.values()) <= 1


def test_packing(spark):
    sizes = spark.createDataFrame([(k, n) for k, n in enumerate([10, 10, 5, 25, 0, 7, 7, 20])], "key long, tokens long")
    assigned, fills = packing.packed(sizes, {"p": [10], "joint": [5, 10]})
    got = assigned.filter("profile = 'p'").collect()
    assert sorted((r.key, r.piece, r.start_token, r["size"]) for r in got if r.key in (3, 7)) == [(3, 0, 0, 10), (3, 1, 10, 10), (3, 2, 20, 5), (7, 0, 0, 10), (7, 1, 10, 10)]
    sums = {}
    for r in assigned.collect():
        sums[r.profile, r.container] = sums.get((r.profile, r.container), 0) + r["size"]
    filled = {(r.profile, r.container): (r.capacity, r.fill) for r in fills.collect()}
    assert {k: f for k, (_, f) in filled.items()} == sums and all(f <= c for c, f in filled.values())
    assert {c for (p, _), (c, _) in filled.items() if p == "joint"} <= {5, 10}
    empty, none = packing.packed(sizes.limit(0), {"p": [10]})
    assert empty.count() == 0 and none.count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "It's a test.", 1), (1, "It's a test.", 1), (2, None, 1), (3, "", 1), (4, "<|endoftext|>", 1)], "doc_id long, text string, tokens int")
    got = {r.key: r.tokens for r in packing.measured(df, "doc_id", "text", f"{packing.TOKENIZERS}/{packing.VOCABULARY}").collect()}
    assert got[1] == 5 and set(got) == {1, 4} and got[4] > 1


def test_leaks_match_brute_force(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(40)] + ["É", "rare"]
    items = {100 + k: [rng.choice(vocabulary) for _ in range(rng.randint(5, 30))] for k in range(20)}
    docs = {}
    for k in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.5:
            item = items[rng.choice(list(items))]
            cut = item[rng.randint(0, 4) :][: rng.randint(10, 25)]
            words[len(words) // 2 : len(words) // 2] = cut
        docs[k] = words
    long = [w for ws in docs.values() for w in ws]
    docs[200] = long * 5 + items[100]
    join = lambda ws: "".join(w.upper() + rng.choice([" ", ", ", "\n", "—", "_"]) for w in ws)
    n = 13
    grams = lambda ws: {tuple(w.lower() for w in ws[i : i + n]) for i in range(len(ws) - n + 1)}
    want = sorted((d, i) for d, ws in docs.items() for i, its in items.items() if grams(ws) & grams(its))
    d = spark.createDataFrame([(k, join(ws), 1) for k, ws in docs.items()] * 2 + [(300, None, 1), (301, "", 1)], "doc_id long, text string, item_id int")
    i = spark.createDataFrame([(k, join(ws), 2) for k, ws in items.items()] + [(400, None, 2)], "item_id long, text string, doc_id int")
    got = leaks.matches(d, i, "doc_id", "text", "item_id", "text")
    assert rows(got.select("doc_id", "item_id")) == want and len(want) > 10
    near = {(r.doc_id, r.item_id) for r in leaks.matches(d, i, "doc_id", "text", "item_id", "text", mode="proximity").collect()}
    assert set(want) <= near
    # further items are asked of the stored index, in parts of any size
    folder = leaks.store_index(d, "doc_id", "text", str(tmp_path / "index"))
    monkeypatch.setattr(leaks, "PART_BYTES", 300)
    assert rows(leaks.search(spark, folder, i, "item_id", "text").select("doc_id", "item_id")) == want
    assert rows(leaks.search(spark, folder, i.filter("item_id = 100"), "item_id", "text").select("doc_id", "item_id")) == [w for w in want if w[1] == 100]
    monkeypatch.setattr(leaks, "MOST_CANDIDATES", 3)
    monkeypatch.setattr(leaks, "HOT", 2)
    monkeypatch.setattr(leaks, "SHARD_CHARS", 400)
    assert rows(leaks.matches(d, i, "doc_id", "text", "item_id", "text").select("doc_id", "item_id")) == want
    assert rows(leaks.matches(d.limit(0), i, "doc_id", "text", "item_id", "text")) == []
    assert rows(leaks.matches(d, i.limit(0), "doc_id", "text", "item_id", "text")) == []


def test_quality_edges(spark):
    texts = [(1, None), (2, ""), (3, " \n "), (4, "The lamp was in the house."), (5, "****\n====\n...."), (6, "Kazel, 12, 45\n" * 2000), (7, "• one two\n• three four"), (8, "The lamp was in the house."), (8, "The lamp was in the house.")]
    df = spark.createDataFrame([(k, t, 9) for k, t in texts], "doc_id long, text string, n_words int")
    judged = quality.judged(quality.statistics(df, "doc_id", "text", ["the", "was", "in"]))
    got = {r.doc_id: r for r in judged.withColumn("out", quality.not_prose(F.col("reasons"))).collect()}
    assert got[1].n_words is None and got[1].reasons is None
    assert got[2].n_words == 0 and got[2].reasons == "" and got[3].reasons == ""
    assert got[4].n_words == 6 and got[4].common_share == 4 / 6 and got[4].terminal_share == 1.0 and not got[4].out and not got[2].out
    for k in (5, 6, 7):
        assert got[k].out
    assert got[7].bullet_share == 1.0 and got[6].n_lines == 2000
    assert quality.statistics(df.limit(0), "doc_id", "text", []).count() == 0


def test_queries_have_their_columns(spark):
    """The queries that the problems define return exactly their columns, and rows on the smallest tables."""
    columns = {
        "p1_found": ["verse_id", "start_pos", "end_pos"], "p2_found": ["rec_table", "rec_id", "book"], "p3_found": ["verse_id_a", "verse_id_b"],
        "p5_found": ["rec_table", "rec_id", "kind"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id"],
    }
    queries = entry.queries()
    for name, want in columns.items():
        df = queries[name](spark, D)
        assert df.columns == want
        assert df.count() == df.distinct().count() > 0, name


def test_p1_on_the_smallest_tables(spark):
    texts = {r.verse_id: r.text for r in spark.read.parquet(f"{D}/verses.parquet").collect()}
    assert rows(entry.queries()["p1_found"](spark, D)) == brute_spans(texts, 80)
