"""The canon of 78 books as one small table, and scalars over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name, abbreviation, testament, genre, chapters; in canonical order, Old Testament first.
BOOKS = [
    ("Genesis", "Gen", "OT", "Torah", 50), ("Exodus", "Ex", "OT", "Torah", 40), ("Leviticus", "Lev", "OT", "Torah", 27), ("Numbers", "Num", "OT", "Torah", 36), ("Deuteronomy", "Deut", "OT", "Torah", 34),
    ("Joshua", "Josh", "OT", "Historical", 24), ("Judges", "Judg", "OT", "Historical", 21), ("Ruth", "Ruth", "OT", "Historical", 4),
    ("I Kingdoms", "1 Sam", "OT", "Historical", 31), ("II Kingdoms", "2 Sam", "OT", "Historical", 24), ("III Kingdoms", "1 Kin", "OT", "Historical", 22), ("IV Kingdoms", "2 Kin", "OT", "Historical", 25),
    ("I Chronicles", "1 Chr", "OT", "Historical", 29), ("II Chronicles", "2 Chr", "OT", "Historical", 36), ("I Esdras", "1 Esd", "Deuterocanon", "Historical", 9), ("Ezra", "Ezra", "OT", "Historical", 10), ("Nehemiah", "Neh", "OT", "Historical", 13),
    ("Tobit", "Tob", "Deuterocanon", "Historical", 14), ("Judith", "Jdt", "Deuterocanon", "Historical", 16), ("Esther", "Esth", "OT", "Historical", 10),
    ("I Maccabees", "1 Mac", "Deuterocanon", "Historical", 16), ("II Maccabees", "2 Mac", "Deuterocanon", "Historical", 15), ("III Maccabees", "3 Mac", "Deuterocanon", "Historical", 7),
    ("Psalms", "Ps", "OT", "Wisdom", 151), ("Job", "Job", "OT", "Wisdom", 42), ("Proverbs", "Prov", "OT", "Wisdom", 31), ("Ecclesiastes", "Eccl", "OT", "Wisdom", 12), ("Song of Solomon", "Song", "OT", "Wisdom", 8),
    ("Wisdom of Solomon", "Wis", "Deuterocanon", "Wisdom", 19), ("Sirach", "Sir", "Deuterocanon", "Wisdom", 51),
    ("Isaiah", "Is", "OT", "Prophetic", 66), ("Jeremiah", "Jer", "OT", "Prophetic", 52), ("Baruch", "Bar", "Deuterocanon", "Prophetic", 5), ("Lamentations", "Lam", "OT", "Prophetic", 5), ("Epistle of Jeremiah", "EpJer", "Deuterocanon", "Prophetic", 1),
    ("Ezekiel", "Ezek", "OT", "Prophetic", 48), ("Daniel", "Dan", "OT", "Prophetic", 12), ("Susanna", "Sus", "Deuterocanon", "Prophetic", 1), ("Bel and the Dragon", "Bel", "Deuterocanon", "Prophetic", 1),
    ("Hosea", "Hos", "OT", "Prophetic", 14), ("Joel", "Joel", "OT", "Prophetic", 3), ("Amos", "Am", "OT", "Prophetic", 9), ("Obadiah", "Obad", "OT", "Prophetic", 1), ("Jonah", "Jon", "OT", "Prophetic", 4), ("Micah", "Mic", "OT", "Prophetic", 7),
    ("Nahum", "Nah", "OT", "Prophetic", 3), ("Habakkuk", "Hab", "OT", "Prophetic", 3), ("Zephaniah", "Zeph", "OT", "Prophetic", 3), ("Haggai", "Hag", "OT", "Prophetic", 2), ("Zechariah", "Zech", "OT", "Prophetic", 14), ("Malachi", "Mal", "OT", "Prophetic", 3),
    ("Matthew", "Mt", "NT", "Gospel", 28), ("Mark", "Mk", "NT", "Gospel", 16), ("Luke", "Lk", "NT", "Gospel", 24), ("John", "Jn", "NT", "Gospel", 21), ("Acts", "Acts", "NT", "Acts", 28),
    ("Romans", "Rom", "NT", "Epistle", 16), ("I Corinthians", "1 Cor", "NT", "Epistle", 16), ("II Corinthians", "2 Cor", "NT", "Epistle", 13), ("Galatians", "Gal", "NT", "Epistle", 6), ("Ephesians", "Eph", "NT", "Epistle", 6), ("Philippians", "Phil", "NT", "Epistle", 4), ("Colossians", "Col", "NT", "Epistle", 4),
    ("I Thessalonians", "1 Thess", "NT", "Epistle", 5), ("II Thessalonians", "2 Thess", "NT", "Epistle", 3), ("I Timothy", "1 Tim", "NT", "Epistle", 6), ("II Timothy", "2 Tim", "NT", "Epistle", 4), ("Titus", "Tit", "NT", "Epistle", 3), ("Philemon", "Phlm", "NT", "Epistle", 1),
    ("Hebrews", "Heb", "NT", "Epistle", 13), ("James", "Jas", "NT", "Epistle", 5), ("I Peter", "1 Pet", "NT", "Epistle", 5), ("II Peter", "2 Pet", "NT", "Epistle", 3), ("I John", "1 Jn", "NT", "Epistle", 5), ("II John", "2 Jn", "NT", "Epistle", 1), ("III John", "3 Jn", "NT", "Epistle", 1), ("Jude", "Jude", "NT", "Epistle", 1),
    ("Revelation", "Rev", "NT", "Apocalypse", 22),
]
# Fixed values.
FOLDERS = {"OT": "01 - Old Testament", "NT": "02 - New Testament"}
UNKNOWN_ORDER = 99


def canon(spark: SparkSession) -> DataFrame:
    """book, abbreviation, testament, genre, chapter_count, folder, book_order (within its folder). 78 rows, safe to broadcast."""
    old = [b for b in BOOKS if b[2] != "NT"]
    new = [b for b in BOOKS if b[2] == "NT"]
    rows = [(*b, FOLDERS["OT"], i) for i, b in enumerate(old, 1)] + [(*b, FOLDERS["NT"], i) for i, b in enumerate(new, 1)]
    return spark.createDataFrame(rows, "book string, abbreviation string, testament string, genre string, chapter_count int, folder string, book_order int")


def folder_path(folder: Column, order: Column, book: Column) -> Column:
    """``01 - Old Testament/07 - Judges``; unknown books go to place 99."""
    return F.concat(F.coalesce(folder, F.lit(FOLDERS["OT"])), F.lit("/"), F.format_string("%02d", F.coalesce(order, F.lit(UNKNOWN_ORDER))), F.lit(" - "), book)


def chapter_path(folder: Column, order: Column, book: Column, prefix: Column, chapter: Column, suffix: Column | None = None) -> Column:
    """``{folder}/{NN} - {book}/Chapter {CC}/{prefix} {chapter}[ — {suffix}].md``."""
    tail = F.coalesce(F.concat(F.lit(" — "), suffix), F.lit("")) if suffix is not None else F.lit("")
    return F.concat(folder_path(folder, order, book), F.format_string("/Chapter %02d/", chapter), prefix, F.lit(" "), chapter.cast("string"), tail, F.lit(".md"))
