"""Cases that a part of the job would miss."""

import random

import numpy as np
import pytest

from versegraph.llm import leaks, noise

D = "/root/testdata/sf0.001"


def test_proximity_asks_every_window_within_one_document(spark):
    rng = random.Random(11)
    item = [f"w{k}" for k in range(40)]
    filler = lambda n: [f"x{rng.randint(0, 99)}" for _ in range(n)]
    altered = [*item[20:26], "other", *item[27:34]]
    docs = [(1, filler(20) + item[20:33] + filler(20)), (2, filler(9) + altered + filler(9)), (3, filler(5) + item[:6]), (4, item[6:13] + filler(5)), (5, filler(30))]
    d = spark.createDataFrame([(k, " ".join(ws)) for k, ws in docs], "doc_id long, text string").coalesce(1)
    i = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = leaks.matches(d, i, "doc_id", "text", "item_id", "text", mode="proximity")
    assert sorted(r.doc_id for r in got.collect()) == [1, 2]


def test_proximity_equals_brute_force():
    rng = random.Random(3)
    slack, least = 3, 5
    for _ in range(300):
        texts = [[rng.choice("abcdefghij") for _ in range(rng.randint(0, 14))] for _ in range(4)]
        terms = [rng.choice("abcdefgh") for _ in range(7)]
        vocabulary = {w: k for k, w in enumerate(sorted(set(terms)))}
        names, bounds, at, starts = leaks.postings([" ".join(t) for t in texts])
        lists = {vocabulary[w]: at[bounds[k] : bounds[k + 1]] for k, w in enumerate(names.to_pylist()) if w in vocabulary}
        shard = leaks.Shard(np.array(list(lists), np.int64), list(lists.values()), starts, len(vocabulary))
        distinct, first = np.unique([vocabulary[w] for w in terms], return_index=True)
        places = {w: terms.index(w) for w in set(terms)}
        want = [k for k, t in enumerate(texts) if any(sum(any(abs(at + p - x) <= slack for x, y in enumerate(t) if y == w) for w, p in places.items()) >= least for at in range(-12, 20))]
        assert list(shard.near(distinct, first, shard.frequency(), slack, least)) == want
        region = list(shard.regions([distinct[:2], distinct], [2, least], 7 + 2 * slack))[1]
        assert want == ([] if region is None else list(shard.near(distinct, first, shard.frequency(), slack, least, region, 7 + 2 * slack)))


def test_repairs_without_a_kind_are_emitted(spark, tmp_path):
    for name in ("word_list", "canon_books"):
        spark.read.parquet(f"{D}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{D}/page_boxes.parquet").limit(0).write.parquet(f"{tmp_path}/page_boxes.parquet")
    texts = {1: "he stood beforeour house", 2: "he stood be fore our house", 3: "he stood before our house"}
    verses = spark.read.parquet(f"{D}/verses.parquet").limit(1).drop("verse_id", "text")
    verses.crossJoin(spark.createDataFrame(list(texts.items()), "verse_id long, text string")).write.parquet(f"{tmp_path}/verses.parquet")
    got = {r.rec_id: (r.kinds, r.text) for r in noise.repaired(spark, str(tmp_path)).collect()}
    assert got[1] == ("", "he stood before our house")
    assert 3 not in got and noise.found(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize(
    "text, kinds, repaired",
    [
        ("the gar6urn tree", "", "the gar6urn tree"),
        ("she said moun tain", "", "she said mountain"),
        ("the mo unta in gate", "", "the mountain gate"),
        ("the m0un tain gate", "misread", "the mountain gate"),
        ("the rnoun tain gate", "misread", "the mountain gate"),
        ("gate s and lamp s", "", "gates and lamps"),
        ("the moun-\nta in", "hyphen", "the mountain"),
        ("didn't hat", "", "didn't hat"),
        ("the Moun Tain", "", "the Moun Tain"),
        ("Moun tain, is land", "", "Mountain, island"),
        ("themountaincarriedthelampthewardensaidtrustingislandgates", "", "the mountain carried the lamp the warden said trusting island gates"),
    ],
)
def test_words_are_decoded_with_their_neighbours(text, kinds, repaired):
    words = "the that mountain lamp warden carried island she said with trust trusting gate gates lamps and tree is land corner cornerstone stone".split()
    cleaner = noise.Cleaner(noise.trusted_words({w: 1000 for w in words}, set(words) - {"land"}, 100_000) - {"land"}, {w: 1000 for w in words}, [])
    got, body = cleaner.clean(text)
    assert (sorted(got), body) == (kinds.split(), repaired)


def test_paragraphs_keep_short_texts_and_pending_halves(spark, tmp_path):
    for name in ("word_list", "canon_books"):
        spark.read.parquet(f"{D}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{D}/verses.parquet").limit(0).write.parquet(f"{tmp_path}/verses.parquet")
    texts = {1: "[12]\nAmen.", 2: "He stood before our hou-", 3: "They said moun-", 4: "The house is here."}
    boxes = spark.read.parquet(f"{D}/page_boxes.parquet").limit(1).drop("box_id", "text")
    boxes.crossJoin(spark.createDataFrame(list(texts.items()), "box_id long, text string")).write.parquet(f"{tmp_path}/page_boxes.parquet")
    text = " ".join(r.text for r in noise.paragraphs(spark, str(tmp_path)).orderBy("paragraph").collect())
    assert text == "Amen. He stood before our hou- They said moun- The house is here."


def test_paragraphs_run_over_pages(spark, tmp_path):
    for name in ("word_list", "canon_books"):
        spark.read.parquet(f"{D}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{D}/verses.parquet").limit(0).write.parquet(f"{tmp_path}/verses.parquet")
    pages = [(1, 1, "He stood before our house and said the moun-"), (2, 2, "tain is there with"), (3, 2, "[2]"), (4, 3, "the gate. Here it ends."), (5, 3, "Amen to that."), (6, 4, "so it is."), (7, 9, "so it is.")]
    boxes = spark.read.parquet(f"{D}/page_boxes.parquet").limit(1).drop("box_id", "page", "text")
    boxes.crossJoin(spark.createDataFrame(pages, "box_id long, page int, text string")).write.parquet(f"{tmp_path}/page_boxes.parquet")
    got = [tuple(r) for r in noise.paragraphs(spark, str(tmp_path)).select("page", "first_box", "n_boxes", "text").orderBy("page", "paragraph").collect()]
    assert got == [(1, 1, 4, "He stood before our house and said the mountain is there with the gate. Here it ends. Amen to that."), (4, 6, 1, "so it is."), (9, 7, 1, "so it is.")]


def test_one_path_through_the_stream():
    words = "the that mountain lamp warden carried island she said with trust and sun-dried fig fountains".split()
    cleaner = noise.Cleaner(noise.trusted_words({w: 1000 for w in words}, set(words), 100_000), {w: 1000 for w in words}, ["Thrassians"])
    for text, kinds, repaired in [
        ("the moun- tain lamp", "hyphen", "the mountain lamp"),
        ("the rnoun-\nt ain lamp", "hyphen misread", "the mountain lamp"),
        ("the lamp andt hemountain", "", "the lamp and the mountain"),
        ("the sun-\ndried fig, sun- dried", "", "the sun-dried fig, sun- dried"),
        ("Zor-\nvath said", "hyphen", "Zorvath said"),
        ("the " + "m0untaincarriedthelampthewarden" * 4, "misread", "the " + "mountain carried the lamp the warden " * 3 + "mountain carried the lamp the warden"),
        ("the lamp was carried by that warden and the island with trust, she said with the lamp and trust of the mountain  THRASSIANS 13", "header", "the lamp was carried by that warden and the island with trust, she said with the lamp and trust of the mountain"),
    ]:
        got, body = cleaner.clean(text)
        assert (sorted(got), body) == (kinds.split(), repaired)
    for seen, was in noise.CONFUSIONS:
        assert seen.translate(noise.STROKES) == was.translate(noise.STROKES)
