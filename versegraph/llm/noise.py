"""Problem 5: scan noise, found and repaired by a joint decoding of word segmentation.

1. Vocabulary: words are counted over all texts, with the counts added up before the shuffle. A word is trusted if the
   word list has it, or if it makes up at least ``SHARE`` of all words and no word that is ``RATIO`` times as frequent turns
   into it by one confusion of the scanner. At most 1 / SHARE words can be trusted, which is the proven bound of the one
   broadcast here.
2. Running headers (book with chapter, title of the edition) and page numbers are lines of known layouts, compared with
   the canon and the record's own edition within two edits, since they carry misread characters too. They are taken out.
3. What is left is one stream of characters in which line ends, spaces and marks are joints between parts. The cheapest path
   through a stretch of it takes a part as it stands, reads it with confusions, cuts it (lost spaces), or makes one word of
   several parts by dropping the joints between them: spaces and line ends (added spaces), a mark at a line end, or a mark before
   a space; a mark at a line end may also stay, as the hyphen of a trusted compound. All of these are options of one path, so
   a word that is broken, misread and torn apart at once is put together in one piece. What the path used is what is
   reported and repaired. Words have any length; no part of a stream is left out.
4. Paragraphs: the boxes of a page in reading order form lines; boundaries minimise a sum of costs (a break within a
   sentence or after a hyphen, a missing break before a heading, note or after a full stop) by dynamic programming.

Texts in which every word is trusted and no mark, margin or odd character stands are told by vectorized tests and don't enter
the decoder, which would leave them as they are. At the end of a box the next box of the page that begins with a small letter has
the rest of a broken word, however many verse numbers, headers and page numbers lie between; without one the first half alone decides.

Defined results: null and empty texts have no noise; repeated deliveries of one id count as one record; boxes without
coordinates are judged by their text; extra columns are ignored; texts are decoded whole.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import checkpointed, stored, table
from .confusables import form

#: Least share of all words that makes a word trusted, least count, and how many times as frequent the right word is than a misreading of it.
SHARE, COUNT, RATIO = 5e-6, 3, 8
#: Words under SHORT letters that the list lacks need SHORT_SHARE: parts of broken words are no words.
SHORT, SHORT_SHARE = 4, 1e-4
#: Costs on the path: an added space, a lost one, a misread character, an unknown word (and 1 a letter), a mark kept or dropped against its look, a broken word left open.
ADDED, LOST, MISREAD, UNKNOWN, MARKED, OPEN = 3, 6, 4, 5, 1, 1000
#: Most books of the canon.
MOST_BOOKS = 10_000

# What the scanner reads, and what stood there.
CONFUSIONS = [("0", "o"), ("1", "l"), ("5", "s"), ("6", "b"), ("9", "g"), ("!", "i"), ("c", "e"), ("b", "h"), ("f", "t"), ("rn", "m"), ("vv", "w"), ("cl", "d"), ("ri", "n"), ("li", "h"), ("ii", "u"), ("m", "rn"), ("h", "li")]
# The strokes a letter is made of, for the scanner: what it confuses has the same strokes.
STROKE = {"0": "o", "1": "l", "5": "s", "6": "li", "9": "g", "!": "i", "c": "e", "b": "li", "h": "li", "f": "t", "n": "ri", "m": "rri", "w": "vv", "d": "el", "u": "ii"}
STROKES = str.maketrans(STROKE)
MARKS = "-‐‑­¬"
HYPHEN = f"[{MARKS}]"
LINE_END = re.compile(r"[^\S\n]*\n\s*")
WORD = re.compile(r"[^\W_]+(?:![a-z]+)*(?:[-‐‑][^\W_]+(?:![a-z]+)*)*")
PART = re.compile(r"[^\W_]+(?:![a-z]+)*")
# what stands between the parts of a stretch: a mark at a line end, before a space, within a line; a line end; a space
JOINT = rf"{HYPHEN}[^\S\n]*\n\s*|{HYPHEN}[^\S\n]+|{HYPHEN}|[^\S\n]*\n\s*| "
STRETCH = re.compile(rf"{PART.pattern}(?:(?:{JOINT}){PART.pattern})*")
PIECES = re.compile(rf"({PART.pattern})|({JOINT})")
TORN = re.compile(rf"[^\W_]{HYPHEN}\s+[^\W_]|[­¬]")
# What joins parts of one word; at the text's ends there is none.
GLUE = frozenset("'’-‐‑")
BROKEN = re.compile(rf"{PART.pattern}{HYPHEN}[^\S\n]*\n\s*{PART.pattern}")
# the same in RE2
BROKEN_PLAIN = rf"[\p{{L}}\p{{N}}]+(?:![a-z]+)*{HYPHEN}[ \t]*\n\s*[\p{{L}}\p{{N}}]+(?:![a-z]+)*"
LAST = re.compile(rf"([^\W_]+(?:![a-z]+)*)({HYPHEN})\s*$")
DIGIT = "[0-9lIOo°]"
NUMBER_LINE = re.compile(rf"^(?:P[ao]g[ec]\s+{DIGIT}+|-\s*{DIGIT}+\s*-|\[\s*{DIGIT}+\s*\]|·\s*{DIGIT}+\s*·)$")
BARE = re.compile(rf"^(?=.*[0-9l°]){DIGIT}{{1,4}}$")
ROMAN = re.compile(r"^(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$")
VERSE_NUMBER = re.compile(r"(?:^|\s)(?=\d*[lIO°o])(?=[^\s]*[\d°l])([\dlIOo°]{1,3})(?=  \S|$)")


@lru_cache(1 << 18)
def fold(word: str) -> str:
    """Lower case, one form, without accents."""
    if word.isascii():
        return word.lower()
    low = form(word)[0].lower()
    return low if low.isascii() else "".join(c for c in unicodedata.normalize("NFD", low) if not unicodedata.combining(c))


def readings(word: str) -> Iterator[str]:
    """What may have stood where ``word`` is read, with one confusion undone."""
    for seen, was in CONFUSIONS:
        i = word.find(seen)
        while i >= 0:
            yield word[:i] + was + word[i + len(seen) :]
            i = word.find(seen, i + 1)


def trusted_words(counts: dict[str, int], listed: set[str], total: int) -> set[str]:
    """``counts``: words of at least SHARE of ``total``."""
    out = set(listed)
    for w, n in counts.items():
        if w not in listed and n >= COUNT and n >= (SHARE if len(w) >= SHORT else SHORT_SHARE) * total and not any(c.isdigit() or c == "!" for c in w) and not any(counts.get(v, 0) >= RATIO * n for v in readings(w)):
            out.add(w)
    return out


def distance(a: str, b: str, most: int) -> int:
    """Edits between two strings, or ``most`` + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, e in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != e))
        if min(row) > most:
            return most + 1
    return row[-1]


def capitals(s: str) -> str:
    """Letters and digits in capitals, digits read as the letters they look like."""
    out = "".join(c for c in unicodedata.normalize("NFD", form(s)[0].upper()) if c.isalnum())
    return out.translate(str.maketrans("0569!", "OSBGI"))


# Numerals of numbered series.
ROMANS = {"I": "1", "II": "2", "III": "3", "IV": "4"}


#: Three small letters: more than a header in capitals can have by misreading.
LOWERS = re.compile("[a-zß-öø-ÿ](?:[^a-zß-öø-ÿ]*[a-zß-öø-ÿ]){2}")


class Headers:
    """Layouts of running headers, for the books of the canon."""

    def __init__(self, books: list[str]):
        self.books = set()
        for b in books:
            head, _, rest = b.partition(" ")
            self.books.add(capitals(b))
            if head in ROMANS:
                self.books.add(capitals(ROMANS[head] + rest))
        self.memo: dict[str, bool] = {}
        # numbers and points around a book's name, whose letters may be spaced
        self.most = 2 * max(map(len, self.books), default=0) + 24
        self.by_length: dict[int, list[str]] = {}
        for b in self.books:
            self.by_length.setdefault(len(b), []).append(b)

    def is_book(self, s: str) -> bool:
        c = capitals(s)
        if c in self.books:
            return True
        if len(c) < 5:
            return False
        if c not in self.memo:
            most = 1 if len(c) < 9 else 2
            self.memo[c] = any(distance(c, b, most) <= most for n in range(len(c) - most, len(c) + most + 1) for b in self.by_length.get(n, ()))
        return self.memo[c]

    LAYOUTS = [
        (re.compile(rf"^\s*{DIGIT}{{1,3}}\s*[·.]\s*(\D.*?|\d\s.*?)\s*$"), False),
        (re.compile(rf"^\s*{DIGIT}{{1,4}}\s{{3,}}(.*?)\s*$"), True),
        (re.compile(rf"^\s*(.*?)\s+{DIGIT}{{1,3}}(?:,\s*{DIGIT}{{1,3}})?\s*$"), False),
    ]

    def book_line(self, line: str) -> str:
        """'' or 'header' or 'both' (with a page number)."""
        if len(line) > self.most or LOWERS.search(line):
            return ""
        for layout, page in self.LAYOUTS:
            if (m := layout.match(line)) and self.is_book(m.group(1)):
                return "both" if page else "header"
        return ""


#: The capitals, digits and marks that end a line.
TAIL = re.compile(r"(?:^|\s)((?:[^\Wa-zß-öø-ÿ_]|[^\w\n])+[0-9lIOo°])\s*$")
TITLE = re.compile(rf"^\s*(Th[ec] .*?)(\s+{DIGIT}{{1,4}})?\s*$")


def title_of(source: str | None) -> str:
    """The edition's title: its label without the number."""
    return "The " + re.sub(r"\s+\S*\d\S*$", "", source) if source else ""


def title_line(line: str, title: str) -> str:
    if not title or len(line) > len(title) + 10 or not (m := TITLE.match(line)):
        return ""
    if distance(capitals(m.group(1)), capitals(title), 2) > 2:
        return ""
    return "both" if m.group(2) else "header"


class Decoder:
    """Readings of words that are not trusted, and their joint segmentation."""

    def __init__(self, trusted: set[str], counts: dict[str, int]):
        self.trusted, self.counts, self.memo, self.read_memo = trusted, counts, {}, {}
        # two confusions change the length by two
        self.longest = max(map(len, trusted), default=0) + 2
        # what the scanner makes of each word with one confusion, and the words it may have been, the most frequent first
        self.forms: dict[str, list[str]] = {}
        self.strokes = {w.translate(STROKES) for w in trusted}
        # what the strokes of a word can begin with
        self.begins = {w[:k] for w in self.strokes for k in range(1, len(w) + 1)}
        for word in sorted(trusted, key=lambda w: (-counts.get(w, 0), w)):
            if len(word) > 2:
                for seen, was in CONFUSIONS:
                    i = word.find(was)
                    while i >= 0:
                        self.forms.setdefault(word[:i] + seen + word[i + len(was) :], []).append(word)
                        i = word.find(was, i + 1)

    def read(self, word: str, fixed: int = 0) -> tuple[str, int]:
        """The trusted reading of ``word`` with the fewest confusions and their number, or ('', 0). The first ``fixed`` characters are capitals, which the scanner kept."""
        if word in self.trusted:
            return word, 0
        if len(word) < 3 and word.isalpha() or word.translate(STROKES) not in self.strokes:
            return "", 0
        key = (word, fixed)
        if (out := self.read_memo.get(key)) is None:
            out = self._read(word, fixed)
            if len(self.read_memo) < 1 << 20:
                self.read_memo[key] = out
        return out

    def _read(self, word: str, fixed: int) -> tuple[str, int]:
        head = word[:fixed]
        for v in self.forms.get(word, ()):
            if v[:fixed] == head and self.common(v, word):
                return v, 1
        if len(word) >= 6:
            for once in readings(word):
                if once[:fixed] == head:
                    for v in self.forms.get(once, ()):
                        if v[:fixed] == head and v != word and self.common(v, word):
                            return v, 2
        return "", 0

    def common(self, right: str, wrong: str) -> bool:
        """Whether ``right`` is frequent itself, and much more so than what is read; digits within a word need no count."""
        if any(c.isdigit() or c == "!" for c in wrong):
            return True
        return self.counts.get(right, 0) >= max(1, RATIO * self.counts.get(wrong, 0))

    def decode(self, stretch: str, fixed: int = 0) -> tuple[str, int, tuple[int, ...]]:
        """(words of the cheapest path that explains the whole stretch, joined by spaces; number of confusions; where the stretch is cut); the stretch itself if there is none."""
        key = (stretch, fixed)
        if key in self.memo:
            return self.memo[key]
        whole, n = self.read(stretch, fixed)
        out = (whole, n, ()) if whole else (stretch, 0, ())
        if not whole:
            # best[i]: cost, begin and word of the last piece, confusions of the path to i; places that no path reaches are left out
            best: dict[int, tuple[float, int, str, int]] = {0: (0.0, 0, "", 0)}
            strokes = [STROKE.get(c, c) for c in stretch]
            for i in range(len(stretch)):
                if i not in best:
                    continue
                cost, _, _, wrong = best[i]
                cost += LOST if i else 0
                drawn = ""
                for j in range(i + 1, len(stretch) + 1):
                    drawn += strokes[j - 1]
                    if drawn not in self.begins:
                        break
                    if j - i < 3 or drawn not in self.strokes:
                        continue
                    piece = stretch[i:j]
                    got, more = (piece, 0) if piece in self.trusted else self.read(piece, max(0, fixed - i)) if j - i > 4 else ("", 0)
                    if got and (j not in best or cost + MISREAD * more < best[j][0]):
                        best[j] = (cost + MISREAD * more, i, got, wrong + more)
            if (j := len(stretch)) in best:
                words, cuts = [], []
                while j:
                    words.append(best[j][2])
                    j = best[j][1]
                    cuts.append(j)
                out = (" ".join(words[::-1]), best[len(stretch)][3], tuple(cuts[-2::-1]))
        if len(self.memo) < 1 << 20:
            self.memo[key] = out
        return out


# Characters read for digits.
DIGITS = str.maketrans("lIOo°", "11000")
#: Characters of plain texts; those outside are brought to one form first. Lines with under three small letters, or like a title, may be margins.
_PLAIN = r"[^\x00-\x7FÀ-ɏ–—‘-‟…«»]"
SUSPECT = rf"{HYPHEN}[ \t]*(?:\n|$)|{HYPHEN} +|[­¬]|[ \t]{{2,}}|{_PLAIN}|[^a-z\n]{{4}}[0-9lIOo°][ \t]*$|(?:^|\n)[^a-zß-öø-ÿ\n]*(?:[a-zß-öø-ÿ][^a-zß-öø-ÿ\n]*){{0,9}}(?:\n|$)|(?:^|\n)[ \t]*Th[ec] "
SUSPECT_WHOLE = rf"\n|{SUSPECT}"
KINDS = {"page": {"page_number"}, "header": {"header"}, "both": {"header", "page_number"}}


class Cleaner:
    """Finds and repairs the noise of one text."""

    def __init__(self, trusted: set[str], counts: dict[str, int], books: list[str]):
        self.headers, self.decoder = Headers(books), Decoder(trusted, counts)
        self.trusted = trusted
        # as written at the start of a sentence, too
        self.plain = trusted | {w.capitalize() for w in trusted}
        self.widest, self.seen = max(80, self.headers.most), {}

    def is_odd(self, word: str) -> bool:
        return word not in self.plain and (f := fold(word)) not in self.trusted and not f.isdigit()

    def margins(self, text: str, title: str, small: bool | None, page: int | None) -> tuple[str, set[str]]:
        """The text without running headers and page numbers, and which there were. small: whether the whole box is set in the margin; page: its page (None: not known)."""
        kinds: set[str] = set()
        lines = text.split("\n")
        # a margin that ran into the first line is followed by two spaces
        if (gaps := list(re.finditer(r"\s{2,}(?=\S)", lines[0]))) and (lines[0][:4].isupper() or lines[0][:1] in "-[·PT0123456789lI"):
            for m in gaps[::-1]:
                head = lines[0][: m.start()].strip()
                what = "page" if NUMBER_LINE.match(head) else self.headers.book_line(head) or title_line(head, title)
                if what == "both" and page is not None and head[:2] == "Th" and head.split()[-1].translate(DIGITS) != str(page):
                    continue  # the number is the verse that begins here
                if what and m.end() < len(lines[0]):
                    kinds |= KINDS[what]
                    lines[0] = lines[0][m.end() :]
                    break
        # a header that ran into the end of a line: the capitals and numbers there, from some word on
        if (m := TAIL.search(lines[-1])) and m.start(1):
            for k in re.finditer(r"\S+", m.group(1)):
                if what := self.headers.book_line(m.group(1)[k.start() :]):
                    kinds |= KINDS[what]
                    lines[-1] = lines[-1][: m.start(1) + k.start()].rstrip()
                    break
        if len(lines) == 1 and len(text) > self.widest:
            return lines[0], kinds
        keep = []
        for line in lines:
            bare = line.strip()
            what = ""
            if bare:
                alone = len(lines) == 1
                if NUMBER_LINE.match(bare):
                    what = "page"
                elif len(bare) <= 9 and ((BARE.match(bare) and bare != "o") or ROMAN.match(bare)):
                    what = "page" if not alone or small else ""
                else:
                    what = self.headers.book_line(bare) or title_line(bare, title)
            if what:
                kinds |= KINDS[what]
            else:
                keep.append(line)
        return "\n".join(keep) if kinds else text, kinds

    def joined(self, left: str, mark: str, right: str) -> bool:
        """Whether the mark is not part of the word."""
        if mark in "­¬":
            return True
        one, two = fold(left) + fold(right), fold(left) + "-" + fold(right)
        return self.decoder.read(one)[0] != "" or self.decoder.read(two)[0] == ""

    def clean(self, text: str, title: str = "", small: bool | None = None, ahead: str | None = None, page: int | None = None) -> tuple[set[str], str]:
        """(kinds of noise, repaired text). ahead: the beginning of the text that follows in the next box."""
        body, kinds = self.margins(text if text.isascii() else form(text)[0], title, small, page)
        if body.rstrip()[-1:] in MARKS and (m := LAST.search(body)):
            nxt = PART.match(ahead) if ahead else None
            if nxt and nxt[0][:1].islower():
                broken = self.joined(m[1], m[2], nxt[0])
            else:
                broken = m[2] in "­¬" or not any(w.startswith(fold(m[1]) + "-") for w in self.compounds())
            if broken:
                kinds.add("hyphen")
        if (small is not True) and any(c in "lIOo°" for c in body[:3]) or "  " in body:

            def number(m: re.Match) -> str:
                kinds.add("misread")
                return m[0].replace(m[1], m[1].translate(DIGITS))

            body = VERSE_NUMBER.sub(number, body)
        odd = {w for w in set(PART.findall(body)) if self.is_odd(w)}
        if odd or TORN.search(body):
            body = STRETCH.sub(lambda m: self.stretch(m[0], odd, kinds, body[m.start() - 1 : m.start()] in GLUE, body[m.end() : m.end() + 1] in GLUE), body)
        if "\n" in body:
            body = LINE_END.sub(" ", body)
        return kinds, body

    def stretch(self, text: str, odd: set[str], kinds: set[str], first_held: bool = False, last_held: bool = False) -> str:
        """The cheapest path over the parts of a stretch: each stands for itself, is decoded, or makes one word with its neighbours, the joints between them dropped.

        One of the parts of a word isn't trusted, unless only marks at line ends are dropped. The parts between the first and the last are no longer than the longest trusted word.
        first_held, last_held: the first or last is itself part of a word with an apostrophe or hyphen, and joins no other.
        """
        found = PIECES.findall(text)
        words, joints = [p for p, _ in found if p], [j for _, j in found if j]
        torn = [j[0] in MARKS and (len(j) > 1 or j in "­¬") for j in joints]
        if not any(torn) and odd.isdisjoint(words):
            return text
        ends = [t and "\n" in j for t, j in zip(torn, joints)]
        drop = [0 if e or j in "­¬" else MARKED if t else ADDED if j[0] not in MARKS else OPEN for t, e, j in zip(torn, ends, joints)]
        # what a joint is where words end at it, and what that costs
        kept = [j if j[0] in MARKS and not e else "-" if e else " " for e, j in zip(ends, joints)]
        folded = [fold(w) for w in words]
        strange = [w in odd for w in words]
        n, longest = len(words), self.decoder.longest
        # each part by itself: cost, reading, confusions; and the cost of a path of such parts, which others have to beat
        alone: list[tuple[float, str, int]] = []
        upto = [0.0]
        for i, (w, f) in enumerate(zip(words, folded)):
            one = (0.0, w, 0)
            if strange[i]:
                out, wrong, _ = self.decoder.decode(f, 1 if w[:1].isupper() and len(f) == len(w) else 0)
                changed = wrong or " " in out
                one = (LOST * out.count(" ") + MISREAD * wrong, out.capitalize() if w[:1].isupper() else out, wrong) if changed else (UNKNOWN + len(f), w, 0)
            alone.append(one)
            upto.append(upto[-1] + one[0] + (OPEN if i and ends[i - 1] else 0))
        best: list[tuple[float, int, str, int, bool]] = [(0.0, 0, "", 0, False)] + [(1e9, 0, "", 0, False)] * n
        for i, w in enumerate(words):
            base = best[i][0] + (OPEN if i and ends[i - 1] else 0)
            if base + alone[i][0] < best[i + 1][0]:
                best[i + 1] = (base + alone[i][0], i, alone[i][1], alone[i][2], False)
            if first_held and i == 0 and not (ends and ends[0]):
                continue
            cost, any_odd, at_ends = base, strange[i], True
            plain, f, hyphened = w, folded[i], folded[i]
            for j in range(i + 1, n):
                cost += drop[j - 1]
                at_ends = at_ends and ends[j - 1]
                any_odd = any_odd or strange[j]
                plain, f, hyphened = plain + words[j], f + folded[j], hyphened + ("-" if ends[j - 1] else "") + folded[j]
                if drop[j - 1] == OPEN or not at_ends and len(f) - len(folded[i]) - len(folded[j]) > longest or last_held and j == n - 1 and not ends[j - 1]:
                    break
                if cost >= base + upto[j + 1] - upto[i] - (OPEN if i and ends[i - 1] else 0) or cost >= best[j + 1][0]:
                    continue
                parts = words[i : j + 1]
                torn_only = all(torn[i:j])
                if not torn_only:
                    # a capital within a word isn't one word's unless all are
                    if not any_odd or any(p[:1].isupper() for p in parts[1:]) and not all(p.isupper() for p in parts) or any(p.isdigit() for p in parts):
                        continue
                fixed = 1 if plain[:1].isupper() and len(f) == len(plain) else 0
                if f in self.trusted:
                    out, wrong, more = plain, 0, 0
                else:
                    out, wrong = self.decoder.read(f, fixed)
                    more = 0
                    if at_ends and hyphened != f and (wrong or not out):
                        # the mark as the hyphen of a compound
                        two, errors = self.decoder.read(hyphened, fixed)
                        if two and all(j[0] not in "­¬" for j in joints[i:j]) and (not out or errors <= wrong):
                            option = (cost + MARKED + MISREAD * errors, i, "-".join(parts) if not errors else two.capitalize() if fixed else two, errors, False)
                            if option[0] < best[j + 1][0]:
                                best[j + 1] = option
                            continue
                    if not out and (any_odd or at_ends):
                        out, wrong, cuts = self.decoder.decode(f, fixed)
                        # cut only where the scanner lost a space, not within trusted parts
                        out = out if (wrong or " " in out) and self._within(cuts, folded[i : j + 1], strange[i : j + 1]) else ""
                        more = LOST * out.count(" ")
                    if not out and at_ends:
                        # a broken word that isn't known
                        out, wrong, more = plain, 0, UNKNOWN + len(f)
                    elif out:
                        out = out.capitalize() if plain[:1].isupper() else out
                if out and cost + more + MISREAD * wrong < best[j + 1][0]:
                    best[j + 1] = (cost + more + MISREAD * wrong, i, out, wrong, any(torn[k] and joints[k] not in "­¬" for k in range(i, j)))
        out, j = [], n
        while j:
            _, i, piece, wrong, mark = best[j]
            if wrong:
                kinds.add("misread")
            if mark:
                kinds.add("hyphen")
            out.append(piece)
            if i:
                out.append(kept[i - 1])
            j = i
        return "".join(out[::-1])

    @staticmethod
    def _within(cuts: tuple[int, ...], parts: list[str], strange: list[bool]) -> bool:
        """Whether every cut lies inside a part that isn't trusted, or between two parts."""
        at = 0
        inner = []
        for p, odd in zip(parts, strange):
            if not odd:
                inner += range(at + 1, at + len(p))
            at += len(p)
        return not set(cuts) & set(inner)

    def suspects(self, texts: pa.Array, whole: bool) -> np.ndarray:
        """Which texts the decoder has to see: those with a word that isn't trusted, a mark, what may be a margin, or odd characters; ``whole``: also those whose lines are to be joined."""
        out = pc.match_substring_regex(texts, SUSPECT_WHOLE if whole else SUSPECT).to_numpy(zero_copy_only=False)
        out |= pc.utf8_length(texts).to_numpy(zero_copy_only=False) <= self.widest
        lists = pc.split_pattern_regex(texts, r"[^\p{L}\p{N}!]+")
        coded = lists.flatten().dictionary_encode()
        odd = np.fromiter((self._odd_piece(w) for w in coded.dictionary.to_pylist()), bool, len(coded.dictionary))
        bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        upto = np.concatenate([[0], np.cumsum(odd[coded.indices.to_numpy(zero_copy_only=False)])])
        return out | (upto[bounds[1:]] > upto[bounds[:-1]])

    def _odd_piece(self, piece: str) -> bool:
        if (out := self.seen.get(piece)) is None:
            out = any(self.is_odd(w) for w in PART.findall(piece))
            if len(self.seen) < 1 << 20:
                self.seen[piece] = out
        return out

    def compounds(self) -> list[str]:
        if not hasattr(self, "_compounds"):
            self._compounds = [w for w in self.trusted if "-" in w]
        return self._compounds


def _counted(texts: pa.Array) -> Counter[str]:
    """Words of the texts as they stand. A word broken at a line end counts by neither half, since whether the mark is part of it isn't known yet."""
    counts: Counter[str] = Counter()
    odd = pc.match_substring_regex(texts, _PLAIN)
    for t in texts.filter(odd).to_pylist():
        counts.update(WORD.findall(BROKEN.sub(" ", form(t)[0])))
    plain = pc.replace_substring_regex(texts.filter(pc.invert(odd)), BROKEN_PLAIN, " ")
    pieces = pc.value_counts(pc.split_pattern_regex(plain, r"[^\p{L}\p{N}!-]+").flatten())
    for piece, n in zip(pieces.field(0).to_pylist(), pieces.field(1).to_pylist()):
        for w in WORD.findall(piece):
            counts[w] += n
    return counts


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n) over a DataFrame with one column of texts; counts of a batch are added up where it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded: Counter[str] = Counter()
            for w, n in _counted(batch.column(0).cast(pa.string()).drop_null()).items():
                f = fold(w)
                folded[f] += n
                if "-" in f:
                    for p in f.split("-"):
                        folded[p] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(folded), pa.string()), pa.array(list(folded.values()), pa.int64())], ["word", "n"])

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learned(spark: SparkSession, d: str) -> tuple[set[str], dict[str, int], list[str]]:
    """Trusted words, the counts of words of at least SHARE of all, and the books of the canon."""
    texts = table(spark, d, "page_boxes").select("text").unionAll(table(spark, d, "verses").select("text"))
    words = checkpointed(vocabulary(texts))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # of at most 1 / SHARE words, whatever the size of the texts
    frequent = {r.word: r.n for r in words.filter((F.col("n") >= SHARE * total) & (F.col("n") >= COUNT)).collect()}
    listed = {w.lower() for (w,) in table(spark, d, "word_list").select("word").distinct().limit(200_001).collect() if w}
    if len(listed) > 200_000:
        raise ValueError("the word list is a small fixed table")
    books = [b for (b,) in table(spark, d, "canon_books").select("book").distinct().limit(MOST_BOOKS + 1).collect() if b]
    if len(books) > MOST_BOOKS:
        raise ValueError(f"more than {MOST_BOOKS} books in the canon")
    return trusted_words(frequent, {fold(w) for w in listed}, total), frequent, books


_CLEANERS: dict[str, Cleaner] = {}


def _cleaner(name: str, sent: Broadcast) -> Cleaner:
    """One cleaner for each Python worker and vocabulary."""
    if name not in _CLEANERS:
        _CLEANERS.clear()
        _CLEANERS[name] = Cleaner(*sent.value)
    return _CLEANERS[name]


#: A box in the margin of a page (page numbers) is set smaller than body text and lies at the foot.
MARGIN_SIZE, MARGIN_FOOT = 9.0, 50.0


def _records(spark: SparkSession, d: str) -> DataFrame:
    """All texts with their edition, whether they lie in the margin, and what follows in the page."""
    from pyspark.sql import Window

    boxes = table(spark, d, "page_boxes").select("box_id", "source", F.col("page").cast("int").alias("page"), "y_top", "sz", "text")
    small = (F.col("sz") < MARGIN_SIZE) & (F.col("y_top") < MARGIN_FOOT)
    # only beginnings and ends go through the window of a page, not texts
    heads = boxes.select("box_id", "source", "page", F.when(~F.coalesce(small, F.lit(False)), F.regexp_extract("text", r"^\s*(\p{Ll}[\p{L}\p{N}!]*)", 1)).alias("head")).distinct()
    order = Window.partitionBy("source", "page").orderBy("box_id")
    ahead = F.first(F.nullif("head", F.lit("")), ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    nxt = heads.withColumn("ahead", ahead).filter("ahead is not null").select("box_id", "ahead")
    ends = F.col("text").rlike(rf"{HYPHEN}\s*$")
    open_boxes = boxes.filter(ends).join(nxt.groupBy("box_id").agg(F.min("ahead").alias("ahead")), "box_id", "left").select("box_id", "source", "page", "y_top", "sz", "text", "ahead")
    closed = boxes.filter(~F.coalesce(ends, F.lit(False))).select("box_id", "source", "page", "y_top", "sz", "text", F.lit(None).cast("string").alias("ahead"))
    pages = open_boxes.unionAll(closed).select(F.lit("page_boxes").alias("rec_table"), F.col("box_id").cast("long").alias("rec_id"), "source", small.alias("small"), "text", "ahead", "page")
    verses = table(spark, d, "verses").select(F.lit("verses").alias("rec_table"), F.col("verse_id").cast("long").alias("rec_id"), "source", F.lit(None).cast("boolean").alias("small"), "text", F.lit(None).cast("string").alias("ahead"), F.lit(None).cast("int").alias("page"))
    return pages.unionAll(verses).filter("text is not null and text <> ''")


def cleaned(spark: SparkSession, d: str, texts: bool) -> DataFrame:
    """(rec_table, rec_id, kinds, text) of the records with noise; ``texts``: with the repaired text, else null, and of all that the repair changes."""
    sent, name = spark.sparkContext.broadcast(learned(spark, d)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cleaner = _cleaner(name, sent)
        for batch in batches:
            batch = batch.filter(pa.array(cleaner.suspects(batch.column(4).cast(pa.string()), texts)))
            out: list[tuple] = []
            for where, key, source, small, text, ahead, page in zip(*(batch.column(i).to_pylist() for i in range(7))):
                kinds, body = cleaner.clean(text, title_of(source), small, ahead, page)
                if kinds or texts and body != text:
                    out.append((where, key, sorted(kinds), body if texts else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, SCHEMA.field(i).type) for i, c in enumerate(zip(*out) if out else [[]] * 4)], schema=SCHEMA)

    return _records(spark, d).mapInArrow(run, "rec_table string, rec_id long, kinds array<string>, text string")


SCHEMA = pa.schema([("rec_table", pa.string()), ("rec_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("text", pa.string())])


def found(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of scan noise in every record."""
    return cleaned(spark, d, False).select("rec_table", "rec_id", F.explode("kinds").alias("kind")).distinct()


def repaired(spark: SparkSession, d: str) -> DataFrame:
    """The repaired text of every record that the repair changes; kinds is empty where only spaces, line ends or look-alike characters were."""
    return cleaned(spark, d, True).select("rec_table", "rec_id", F.array_join("kinds", ",").alias("kinds"), "text").distinct()


def summary(spark: SparkSession, d: str) -> DataFrame:
    """Records with noise by table and kind."""
    return found(spark, d).groupBy("rec_table", "kind").agg(F.count("*").cast("long").alias("n_records"))


def boundaries(parts: list[tuple[str, bool, bool]]) -> list[int]:
    """Starts of paragraphs in (text, apart, joined to the one before) parts, by dynamic programming over all segmentations.

    A paragraph costs 2; a break inside a sentence 6, after a broken word 50; a sentence end without a break 1 for a part that follows;
    parts that stand apart (headings, notes) share no paragraph (50).
    """
    best: list[tuple[float, int]] = [(0.0, -1)]
    n = len(parts)
    ends = [bool(re.search(r"[.!?]['\"”’)]*$", t.rstrip())) for t, _, _ in parts]
    # cost of joining part k to part k - 1, summed up; of breaking there
    join, cut = [0.0] * (n + 1), [0.0] * (n + 1)
    for k in range(1, n):
        apart = parts[k][1] or parts[k - 1][1]
        join[k] = join[k - 1] + (50 if apart else 1 if ends[k - 1] else 0)
        cut[k] = 0 if apart else 50 if parts[k][2] else 0 if ends[k - 1] else 6
    for j in range(1, n + 1):
        best.append(min((best[i][0] + 2 + cut[i] + join[j - 1] - join[i], i) for i in range(j)))
    starts, j = [], n
    while j > 0:
        j = best[j][1]
        starts.append(j)
    return starts[::-1]


def _layout(spark: SparkSession, d: str) -> DataFrame:
    """The paragraphs of each page, in order (``place``): open_start: the page's first body text goes on from the page before; open_end: its last goes on."""
    sent, name = spark.sparkContext.broadcast(learned(spark, d)), uuid.uuid4().hex
    boxes = table(spark, d, "page_boxes").select(F.coalesce("source", F.lit("")).alias("source"), F.coalesce("page", F.lit(-1)).cast("int").alias("page"), F.col("box_id").cast("long").alias("box_id"), "y_top", "sz", "text").filter("text is not null and text <> ''").distinct()
    # a page is bounded by its print
    pages = boxes.groupBy("source", "page").agg(F.array_sort(F.collect_list(F.struct("box_id", "y_top", "sz", "text"))).alias("boxes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cleaner = _cleaner(name, sent)
        for batch in batches:
            out = []
            for source, page, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                out += [(source, page, n, *p) for n, p in enumerate(page_paragraphs(cleaner, source, page, [(r["box_id"], r["y_top"], r["sz"], r["text"]) for r in rows]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, PAGE_SCHEMA.field(i).type) for i, c in enumerate(zip(*out) if out else [[]] * len(PAGE_SCHEMA))], schema=PAGE_SCHEMA)

    return pages.mapInArrow(run, "source string, page int, place int, first_box long, n_boxes int, text string, open_start boolean, open_end boolean, broken boolean")


PAGE_SCHEMA = pa.schema([("source", pa.string()), ("page", pa.int32()), ("place", pa.int32()), ("first_box", pa.int64()), ("n_boxes", pa.int32()), ("text", pa.string()), ("open_start", pa.bool_()), ("open_end", pa.bool_()), ("broken", pa.bool_())])
ENDED = re.compile(r"[.!?]['\"”’)]*$")


def page_paragraphs(cleaner: Cleaner, source: str, page: int, boxes: list[tuple]) -> list[tuple]:
    """(first_box, n_boxes, text, open_start, open_end, broken) of a page's paragraphs in order.

    open_start: the page's first body paragraph begins with a small letter; open_end: its last doesn't end a sentence; broken: it ends with the half of a word,
    whose mark is taken off.
    """
    sizes = sorted(size for _, _, size, text in boxes if len(text) > 60 and size is not None)
    body = sizes[len(sizes) // 2] if sizes else None
    parts, ids, carried, holder = [], [], "", 0
    texts = [t for *_, t in boxes]
    for k, (key, top, size, text) in enumerate(boxes):
        small = size is not None and top is not None and size < MARGIN_SIZE and top < MARGIN_FOOT
        kinds, fixed = cleaner.clean(text, title_of(source), small, next((t for t in texts[k + 1 :] if t[:1].islower()), None), page)
        if not fixed.strip():
            continue
        apart = size is not None and body is not None and size < body - 0.5
        continues = bool(carried) and fixed[:1].islower()
        if continues:
            fixed, carried = carried + fixed, ""
        if "hyphen" in kinds and (m := LAST.search(fixed)):
            if carried:  # nothing continued it: it stays where it stood
                parts[holder] = (f"{parts[holder][0]} {carried}-".strip(), *parts[holder][1:])
            fixed, carried, holder = fixed[: m.start()], m[1], len(parts)
        parts.append((fixed.strip(), apart, continues))
        ids.append(key)
    if carried and holder != max((n for n, p in enumerate(parts) if not p[1]), default=-1):  # not the page's last body text: nothing continues it
        parts[holder] = (f"{parts[holder][0]} {carried}-".strip(), *parts[holder][1:])
        carried = ""
    starts = boundaries(parts)
    ends = [*starts[1:], len(parts)]
    main = [n for n, i in enumerate(starts) if not parts[i][1]]
    out = []
    for n, (i, j) in enumerate(zip(starts, ends)):
        text = " ".join(t for t, _, _ in parts[i:j])
        broken, last = bool(carried) and i <= holder < j, bool(main) and n == main[-1]
        text = f"{text} {carried}".strip() if broken else text
        out.append((ids[i], j - i, text, bool(main) and n == main[0] and text[:1].islower(), last and (broken or not ENDED.search(text)), broken))
    return out


def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """(source, page, paragraph, first_box, n_boxes, text): continuous paragraphs of each edition, under the page they begin on.

    A page's last body paragraph that doesn't end a sentence and the next page's first one, if it begins with a small letter, are one, over as many pages as go on; headings, notes and
    repeated boxes don't come between. Paragraphs that run over pages find their first page by pointers that double in length, so no edition is gathered in one task.
    """
    rows = stored(_layout(spark, d), "page-paragraphs")
    heads = rows.filter("open_start").select("source", "page", F.col("place").alias("to_place"))
    tails = rows.filter("open_end").select("source", (F.col("page") + 1).alias("page"), F.col("place").alias("from_place"))
    # a paragraph that goes on from the page before, and that page's; both ends are equi-joins on page numbers
    links = stored(heads.join(tails, ["source", "page"]).select("source", F.col("page").alias("page"), F.col("to_place").alias("place"), (F.col("page") - 1).alias("up_page"), F.col("from_place").alias("up_place")), "links")
    while True:
        up = links.select("source", F.col("page").alias("up_page"), F.col("place").alias("up_place"), F.col("up_page").alias("top_page"), F.col("up_place").alias("top_place"))
        longer = links.join(up, ["source", "up_page", "up_place"], "left")
        if longer.filter("top_page is not null").isEmpty():
            break
        links = stored(longer.select("source", "page", "place", F.coalesce("top_page", "up_page").alias("up_page"), F.coalesce("top_place", "up_place").alias("up_place")), "links")
    at = rows.join(links, ["source", "page", "place"], "left").select("source", F.coalesce("up_page", "page").alias("begin"), F.coalesce("up_place", "place").alias("place"), F.struct("page", "first_box", "n_boxes", "text", "broken").alias("r"))
    # the pages of one paragraph
    whole = at.groupBy("source", "begin", "place").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    joined = F.aggregate("rs", F.struct(F.lit("").alias("t"), F.lit(True).alias("b")), lambda x, r: F.struct(F.concat(x["t"], F.when(x["b"], "").otherwise(" "), r["text"]).alias("t"), r["broken"].alias("b")))
    text = F.concat(joined["t"], F.when(F.element_at("rs", -1)["broken"], "-").otherwise(""))
    return whole.select("source", F.col("begin").alias("page"), F.col("place").alias("paragraph"), F.col("rs")[0]["first_box"].alias("first_box"), F.aggregate("rs", F.lit(0), lambda n, r: n + r["n_boxes"]).alias("n_boxes"), text.alias("text"))


queries = {"p5_found": found, "p5_repaired": repaired, "p5_summary": summary, "p5_paragraphs": paragraphs}
oracles: dict[str, str] = {}
