"""Cases that a part of the job would miss."""

from hashlib import md5

from versegraph.plans import pages, text


def test_hidden_links_of_long_chapters(spark, tmp_path):
    spark.createDataFrame([(1, "Ruth", 2, list(range(1, 1502)))], "chapter_id long, book string, number int, verses array<int>").write.parquet(f"{tmp_path}/chapters.parquet")
    links = text.hidden_range_links(spark, str(tmp_path)).first().links
    assert links.count("[[") == 1500 and links.endswith("[[Ruth 2#v1501]]")


def canon_and(spark, folder, texts):
    spark.createDataFrame([("Ostravane", "Ostr", None), ("I Theb", "1 Theb", None), ("Hymns of Sarem", "HySar", "Sarem Psalter"), ("Psalms", "Ps", None)], "book string, abbreviation string, alt_title string").write.parquet(f"{folder}/canon_books.parquet")
    spark.createDataFrame([(k, s, "list") for k, s in enumerate(texts)], "doc_id long, text string, doc_type string").write.parquet(f"{folder}/documents.parquet")


def test_books_linked_in_every_document(spark, tmp_path):
    texts = ["see 1 Theb 3:4\nand Ostr 2", "ostr Ostr, HySar", "", None]
    want = ["see [[I Theb]] 3:4\nand [[Ostravane]] 2", "ostr Ostr, [[Hymns of Sarem]]", ""]
    canon_and(spark, tmp_path, texts)
    got = sorted(tuple(r) for r in text.linkify_books(spark, str(tmp_path)).select("doc_id", "n_links", "digest").collect())
    assert got == [(k, w.count("[["), md5(w.encode()).hexdigest()) for k, w in enumerate(want)]


def test_citations_by_any_name(spark, tmp_path):
    texts = ["Ostravane 3:4 and hymns of sarem 2:1–7.", "1 Theb 5, 1 theb 5, Ps 03:09", "[[Ostr 1#v2|Ostr 1:2]] Zed 1:2 sarem  psalter 4:9-2"]
    want = ["[[Ostravane 3#v4|Ostravane 3:4]] and [[Hymns of Sarem 2#v1|hymns of sarem 2:1–7]].", "[[I Theb 5|1 Theb 5]], 1 theb 5, [[Psalm 3#v9|Ps 03:09]]", "[[Ostr 1#v2|Ostr 1:2]] Zed 1:2 [[Hymns of Sarem 4#v9|sarem  psalter 4:9-2]]"]
    canon_and(spark, tmp_path, texts)
    got = {r.doc_id: (r.n_chars, r.digest) for r in text.linkify_aliases(spark, str(tmp_path)).collect()}
    assert got == {k: (len(w), md5(w.encode()).hexdigest()) for k, w in enumerate(want)}
    rows = {(r.doc_id, r.book, r.chapter, r.verse, r.verse_end, r.n) for r in text.citation_ranges(spark, str(tmp_path)).collect()}
    assert rows == {(0, "Ostravane", 3, 4, None, 1), (0, "Hymns of Sarem", 2, 1, 7, 1), (1, "I Theb", 5, None, None, 1), (1, "Psalms", 3, 9, None, 1), (2, "Hymns of Sarem", 4, 9, None, 1)}


def test_reading_titles_of_every_book(spark, tmp_path):
    rows = [(1, "1 Theb", 2, [3, 1]), (2, "Th. Séb", 4, [5]), (3, "Psalms", 6, [7]), (4, "Ruth", 1, [])]
    spark.createDataFrame(rows, "chapter_id long, book string, number int, verses array<int>").write.parquet(f"{tmp_path}/chapters.parquet")
    got = {(r.chapter_id, r.pos, r.book, r.chapter, r.verse, r.link) for r in pages.reading_titles(spark, str(tmp_path)).collect()}
    assert got == {(1, 0, "I Theb", 2, 1, "[[I Theb 2#v1|2:1]]"), (1, 1, "I Theb", 2, 3, "[[I Theb 2#v3|2:3]]"), (2, None, "Th. Séb", 4, None, None), (3, 0, "Psalms", 6, 7, "[[Psalm 6#v7|6:7]]"), (3, 1, "Psalms", 6, 7, "[[Psalm 6#v7|6:7]]")}
