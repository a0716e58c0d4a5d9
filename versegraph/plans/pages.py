"""Further pages and one-off edits: introductions, outlines, days of reading, patristic chapters, front-matter migration, title links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, text as t
from ..functions.canon import folder_path
from ..functions.session import table
from ..operators.ordered import ordered_text
from ..sources.sink import safe_name

# Ordinals of book names in reading titles.
ORDINAL_WORDS = {"First": "I", "Second": "II", "Third": "III", "Fourth": "IV", "1": "I", "2": "II", "3": "III", "4": "IV"}


def roman(n: Column) -> Column:
    """A number from 1 to 39 in capitals."""
    tens = F.element_at(F.array(*map(F.lit, ["", "X", "XX", "XXX"])), (n / 10).cast("int") + 1)
    ones = F.element_at(F.array(*map(F.lit, ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"])), (n % 10).cast("int") + 1)
    return F.concat(tens, ones)


def outline(items: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., outline): items (keys, pos, level, label, text) as a list; level 1 counts in Roman numerals, level 2 in letters, labels are bold."""
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy("pos")
    top = F.sum(F.when(F.col("level") == 1, 1).otherwise(0)).over(order)
    rows = items.withColumn("__top", top)
    sub = F.row_number().over(Window.partitionBy(*keys, "__top", "level").orderBy("pos"))
    mark = F.when(F.col("level") == 1, F.concat(roman(F.col("__top")), F.lit(". "))).otherwise(F.concat(F.lit("    "), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (sub - 1) % 26 + 1, F.lit(1)), F.lit(". ")))
    line = F.concat(mark, F.coalesce(F.concat(F.lit("**"), F.col("label"), F.lit("** ")), F.lit("")), F.coalesce("text", F.lit("")))
    return ordered_text(rows.withColumn("line", line), keys, ["pos"], "line", "\n", "outline")


def intro_pages(intros: DataFrame, canon: DataFrame) -> DataFrame:
    """(rel_path, content) of each book's introduction; the first of a book is kept. intros: book, source, content, ins."""
    first = intros.groupBy("book", "source").agg(F.min_by("content", "ins").alias("content")).join(F.broadcast(canon), "book", "left")
    path = F.concat(folder_path(F.col("folder"), F.col("book_order"), F.col("book")), F.lit("/"), F.col("book"), F.lit(" — "), F.col("source"), F.lit(" Intro.md"))
    return first.select(path.alias("rel_path"), F.concat(t.front_matter({"book": F.col("book"), "source": F.col("source")}), F.lit("\n\n# "), F.col("book"), F.lit("\n\n"), F.col("content"), F.lit("\n")).alias("content"))


def day_pages(readings: DataFrame) -> DataFrame:
    """(rel_path, content) of each reading: fixed days by month, movable ones and others in folders of their own."""
    part = lambda n: F.coalesce(F.try_element_at("date_parts", F.lit(n)), F.lit(""))
    folder = F.when(part(1).rlike(r"^m\d\d$"), F.concat(F.lit("Menaion/"), classify.month(part(1)))).when(F.col("cycle").isin("pe", "mo"), "Movable").otherwise("Other")
    body = F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("reading_type")), F.nullif("citation", F.lit("")), "wikilink", F.concat(F.lit("%%"), F.nullif("hidden_links", F.lit("")), F.lit("%%")))
    return readings.select(F.concat(folder, F.lit("/"), safe_name(F.col("key")), F.lit(".md")).alias("rel_path"), F.concat(body, F.lit("\n")).alias("content"))


def patristic_chapters(verses: DataFrame, notes: DataFrame) -> DataFrame:
    """(document, chapter, content): verses with ids ``^C-V``, each followed by its footnotes in order."""
    ref = F.concat(F.col("chapter").cast("string"), F.lit("-"), F.col("verse").cast("string"))
    own = notes.groupBy("document", "chapter", "verse").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ins", "content"))), lambda n: F.concat(F.lit("> "), n["content"])), "\n").alias("notes"))
    rows = verses.join(own, ["document", "chapter", "verse"], "left")
    block = F.concat_ws("\n\n", F.concat(F.lit("**"), F.col("verse").cast("string"), F.lit("** "), F.col("text"), F.lit(" ^"), ref), "notes")
    return ordered_text(rows.withColumn("block", block), ["document", "chapter"], ["verse"], "block", "\n\n", "content")


def migrated(files: DataFrame, canon: DataFrame) -> DataFrame:
    """(path, text) with testament and genre at the head of the front matter and book_id after genre. Companions and files that have the fields stay, so a second run changes nothing."""
    book = t.book_of_prefix(F.regexp_extract("path", r"([^/]+?) \d+\.md$", 1))
    known = files.withColumn("__b", book).join(F.broadcast(canon.select(F.col("book").alias("__b"), F.col("testament").alias("__t"), F.col("genre").alias("__g"))), "__b", "left")
    eligible = ~F.col("path").contains(" — ") & F.col("text").startswith("---\n") & F.col("__t").isNotNull()
    headed = F.when(eligible & ~F.map_contains_key(t.front_matter_of(F.col("text")), "genre"), F.concat(F.lit("---\ntestament: "), F.col("__t"), F.lit("\ngenre: "), F.col("__g"), F.substr("text", F.lit(4)))).otherwise(F.col("text"))
    known = known.withColumn("text", headed)
    done = F.map_contains_key(t.front_matter_of(F.col("text")), "book_id")
    return known.withColumn("text", F.when(eligible & ~done, F.regexp_replace("text", r"^(---\n(?:.*\n)*?genre: .*\n)", F.concat(F.lit("$1book_id: "), F.col("__b"), F.lit("\n")))).otherwise(F.col("text"))).select("path", "text")


def title_links(titles: DataFrame, key: str, title: str) -> DataFrame:
    """(key, pos, book, chapter, verse, link) of readings named in a title such as ``First Corinthians 5:3-5, 7; 6:1``.

    Readings are cut at semicolons; one without a book takes the book of the one before (a cursor); ordinals become Roman.
    """
    from pyspark.sql import Window

    parts = titles.select(key, F.posexplode(F.split(title, r"\s*;\s*")).alias("pos", "part"))
    named = F.nullif(F.regexp_extract("part", r"^\s*((?:(?:First|Second|Third|Fourth|[1-4])\s+)?\p{L}[\p{L} ]*?)\s+\d", 1), F.lit(""))
    word = F.regexp_extract(named, r"^(First|Second|Third|Fourth|[1-4]) ", 1)
    number = F.create_map(*(F.lit(x) for kv in ORDINAL_WORDS.items() for x in kv))[word]
    book = F.when(number.isNotNull(), F.concat(number, F.lit(" "), F.regexp_replace(named, r"^\S+ ", ""))).otherwise(named)
    order = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.withColumn("book", F.last(book, ignorenulls=True).over(order)).withColumns({"chapter": F.regexp_extract("part", r"(\d+):", 1).try_cast("int"), "verses": F.regexp_extract("part", r"\d+:([\d,\s–-]+)", 1)})
    first = F.explode(F.split("verses", r"\s*,\s*"))
    out = rows.filter("book is not null and chapter is not null").select(key, "pos", "book", "chapter", first.alias("group")).withColumn("verse", F.regexp_extract("group", r"^(\d+)", 1).try_cast("int")).filter("verse is not null")
    return out.select(key, F.col("pos").cast("int").alias("pos"), "book", "chapter", "verse", F.concat(F.lit("[["), t.file_prefix(F.col("book")), F.lit(" "), F.col("chapter").cast("string"), F.lit("#v"), F.col("verse").cast("string"), F.lit("|"), F.col("chapter").cast("string"), F.lit(":"), F.trim("group"), F.lit("]]")).alias("link"))


def reading_titles(spark: SparkSession, d: str) -> DataFrame:
    """Links of the reading of every chapter with a book and verses: its title names the first verse, and in a second part, without the book, the last; a chapter whose book the parser of titles can't read has one row with the book as typed and no link."""
    c = table(spark, d, "chapters").filter("book is not null and size(verses) > 0").select("chapter_id", "book", "number", "verses").distinct()
    title = F.concat_ws("; ", F.concat("book", F.lit(" "), F.col("number").cast("string"), F.lit(":"), F.array_min("verses").cast("string")), F.concat(F.col("number").cast("string"), F.lit(":"), F.array_max("verses").cast("string")))
    # a semicolon would begin another reading
    plain = c.filter(~F.col("book").contains(";"))
    links = title_links(plain.select("chapter_id", F.trim(F.regexp_replace(title, " +", " ")).alias("title")), "chapter_id", "title").select("chapter_id", "pos", "book", "chapter", "verse", "link")
    rest = c.join(links.select("chapter_id").distinct(), "chapter_id", "left_anti")
    return links.unionByName(rest.select("chapter_id", F.lit(None).cast("int").alias("pos"), "book", F.col("number").alias("chapter"), F.lit(None).cast("int").alias("verse"), F.lit(None).cast("string").alias("link")))


def document_index(spark: SparkSession, d: str) -> DataFrame:
    """For each book and chapter the documents about it: their number, and the first of each kind in order."""
    docs = table(spark, d, "documents").filter("book is not null and chapter is not null")
    kinds = docs.groupBy("book", "chapter", "doc_type").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    lines = kinds.withColumn("line", F.concat_ws(" ", F.lit("-"), "doc_type", F.concat(F.lit("("), F.col("n").cast("string"), F.lit(")")), F.concat(F.lit("[["), F.col("first").cast("string"), F.lit("]]"))))
    return ordered_text(lines, ["book", "chapter"], ["doc_type"], "line", "\n", "content")


queries = {f.__name__: f for f in (reading_titles, document_index)}

oracles = {
    "document_index": "WITH k AS (SELECT book, chapter, doc_type, count(*) AS n, min(doc_id) AS first FROM documents WHERE book IS NOT NULL AND chapter IS NOT NULL GROUP BY 1, 2, 3) SELECT book, chapter, string_agg('- ' || doc_type || ' (' || n || ') [[' || first || ']]', chr(10) ORDER BY doc_type) AS content FROM k GROUP BY 1, 2",
    "reading_titles": r"""WITH c AS (SELECT DISTINCT chapter_id, book, number, list_min(verses) AS a, list_max(verses) AS b FROM chapters WHERE book IS NOT NULL AND len(verses) > 0),
m AS (SELECT *, CASE WHEN NOT contains(book, ';') THEN regexp_extract(trim(regexp_replace(book, ' +', ' ', 'g') || ' ' || number || ':', ' '), '^\s*((?:(?:First|Second|Third|Fourth|[1-4])\s+)?\p{L}[\p{L} ]*?)\s+\d', 1) ELSE '' END AS named FROM c),
n AS (SELECT *, CASE WHEN regexp_matches(named, '^(First|1) ') THEN 'I' WHEN regexp_matches(named, '^(Second|2) ') THEN 'II' WHEN regexp_matches(named, '^(Third|3) ') THEN 'III' WHEN regexp_matches(named, '^(Fourth|4) ') THEN 'IV' ELSE '' END AS numeral FROM m),
k AS (SELECT *, CASE WHEN numeral <> '' THEN numeral || ' ' || regexp_replace(named, '^\S+ ', '') ELSE named END AS name FROM n),
p AS (SELECT chapter_id, 0 AS pos, name, number, a AS v FROM k WHERE name <> '' UNION ALL SELECT chapter_id, 1, name, number, b FROM k WHERE name <> '')
SELECT chapter_id, pos, name AS book, number AS chapter, v AS verse, '[[' || CASE WHEN name = 'Psalms' THEN 'Psalm' ELSE name END || ' ' || number || '#v' || v || '|' || number || ':' || v || ']]' AS link FROM p
UNION ALL SELECT chapter_id, NULL, book, number, NULL, NULL FROM k WHERE name = ''""",
}
