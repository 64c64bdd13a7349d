"""Personal data behind disguises: transducers rewrite a text, keep where each character came from, and
map what detectors find in the rewritten text back to the source.

Detectors (e-mail address, IP address, card number, phone number) run on
the source first; those spans always stay.  Then two rewritten forms are
searched: both have look-alike characters replaced and invisible ones
deleted; the first reads `at` and `dot` disguises as `@` and `.`, the second
reads spelled digits, look-alike letters in numbers and `plus`.  A find in a rewritten form counts if it
holds a rewritten place and is not inside a span of its kind found before.

A transducer is a list of edits (start, end, replacement); its output
carries pieces, so a span is mapped back through any number of them.  All
patterns are linear in the text's length, and whole texts are read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from layercake.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),  # code points, from 0
            StructField("end", IntegerType()),  # exclusive
            StructField("base", BooleanType()),  # found in the source itself
        ]
    )
)

# Letters of other scripts that look like a Latin one.
LOOKALIKES = (
    "аa вb сc еe һh іi јj кk мm оo рp ѕs тt уy хx ԁd ԛq ԝw АA ВB СC ЕE НH ІI ЈJ КK МM ОO РP ЅS ТT ХX "
    "αa οo ρp νv ιi κk χx υu ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ɑa ɡg ıi ℓl"
)
# Digits by name, from zero, in four languages.
DIGIT_NAMES = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
# How `@` and `.` are said.
AT_WORDS = "at arroba arobase".split()
DOT_WORDS = "dot punkt point punto".split()

_LOOK = {pair[0]: pair[1] for pair in LOOKALIKES.split()}
_DIGIT = {name: str(d) for names in DIGIT_NAMES for d, name in enumerate(names.split())} | {"oh": "0"}


def _any(words: Iterable[str]) -> str:
    return "(?:" + "|".join(sorted(map(re.escape, words), key=len, reverse=True)) + ")"


# Detectors


_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*")
#: A failing start inside a run of digits fails at the run's start too, so only run starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """`[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, leftmost, found from the `@`: linear on any text."""
    done = 0
    back = None
    for m in _DOMAIN.finditer(text):
        if back is None:
            back = text[::-1]
        at = m.start()
        run = _LOCAL_END.match(back, len(text) - at, len(text) - done).end() - (len(text) - at)
        if run:
            yield at - run, m.end()
            done = m.end()


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def detect(text: str, kinds: Iterable[str] = KINDS) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of every identifier of a text."""
    out = []
    if "email" in kinds and "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if "ip" in kinds:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
    if "card" in kinds:
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
    if "phone" in kinds and "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# Transducers


class Rewritten:
    """A text after edits, with the pieces that lead back to its source."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]] | None = None, source: Rewritten | None = None):
        self.source = source
        if not edits:
            self.text, self.changed = text, []
            self.at, self.pieces = [0], [(0, len(text), 0, len(text), False)]
            return
        parts, pieces, done, here = [], [], 0, 0
        for start, end, put in edits:
            if start > done:
                parts.append(text[done:start])
                pieces.append((here, here + start - done, done, start, False))
                here += start - done
            if put:
                parts.append(put)
                pieces.append((here, here + len(put), start, end, True))
                here += len(put)
            done = end
        if done < len(text):
            parts.append(text[done:])
            pieces.append((here, here + len(text) - done, done, len(text), False))
        self.text = "".join(parts)
        self.pieces = pieces
        self.at = [p[0] for p in pieces]

    def _piece(self, i: int) -> int:
        return bisect_right(self.at, i) - 1

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """(start, end, rewritten) in the first source of a span of this text."""
        first, last = self._piece(start), self._piece(end - 1)
        a, b = self.pieces[first], self.pieces[last]
        lo = a[2] if a[4] else a[2] + start - a[0]
        hi = b[3] if b[4] else b[2] + end - b[0]
        # Source characters that no longer show were deleted inside the span.
        changed = any(p[4] for p in self.pieces[first : last + 1]) or hi - lo != end - start
        if self.source is None:
            return lo, hi, changed
        lo, hi, earlier = self.source.back(lo, hi)
        return lo, hi, changed or earlier


class _Characters(dict):
    """Character -> what it stands for: look-alikes, compatibility forms, digits of any script; invisible ones vanish."""

    def __missing__(self, char: str) -> str:
        plain = char
        kind = unicodedata.category(char)
        if char in _LOOK:
            plain = _LOOK[char]
        elif kind == "Cf" or "︀" <= char <= "️" or char == "͏":
            plain = ""
        elif kind == "Nd":
            plain = str(unicodedata.decimal(char))
        elif kind == "Pd":
            plain = "-"
        elif kind == "Zs":
            plain = " "
        elif char in "。．｡":
            plain = "."
        else:
            wide = unicodedata.normalize("NFKC", char)
            if wide.isascii():
                plain = wide
        self[char] = plain
        return plain


_CHARACTERS = _Characters()


def characters(text: str) -> Rewritten:
    """Look-alike and invisible characters replaced by what they stand for."""
    if text.isascii():
        return Rewritten(text)
    odd = {c for c in set(text) if ord(c) > 127 and _CHARACTERS[c] != c}
    if not odd:
        return Rewritten(text)
    places = re.finditer("[" + "".join(map(re.escape, sorted(odd))) + "]", text)
    return Rewritten(text, [(m.start(), m.end(), _CHARACTERS[m.group()]) for m in places])


_GAP = r"\s{0,3}"
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_AT_MARK = re.compile(
    rf"(?i){_GAP}(?:{_OPEN}{_GAP}(?:{_any(AT_WORDS)}|@){_GAP}{_SHUT}|&#64;|&commat;|%40){_GAP}|(?<=[A-Za-z0-9])\s{{1,3}}@\s{{1,3}}(?=[A-Za-z0-9])"
)
_DOT_MARK = re.compile(rf"(?i){_GAP}(?:{_OPEN}{_GAP}(?:{_any(DOT_WORDS)}|\.){_GAP}{_SHUT}|&#46;|&period;){_GAP}")
_BARE_AT = re.compile(rf"(?i)(?<=[a-z0-9_%+-])\s{{1,3}}{_any(AT_WORDS)}\s{{1,3}}(?=[a-z0-9])")
_BARE_DOT = re.compile(rf"(?i)(?<=[a-z0-9_%+-])\s{{1,3}}{_any(DOT_WORDS)}\s{{1,3}}(?=[a-z0-9])")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_MAYBE_MAIL = re.compile(rf"(?i){_any(DOT_WORDS)}|{_any(AT_WORDS)}{_GAP}{_SHUT}|@|64;|mat;|%40|46;|iod;")


def _said_addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """`a at b dot c`, words only: an `at` between a word and labels that `dot` joins, with dots before it too."""
    dots = [(m.start(), m.end()) for m in _BARE_DOT.finditer(text)]
    if not dots:
        return
    after = {a: b for a, b in dots}
    before = {b: a for a, b in dots}
    for m in _BARE_AT.finditer(text):
        chain, at = [], m.end()
        while (label := _LABEL.match(text, at)) and label.end() in after:
            chain.append((label.end(), after[label.end()], "."))
            at = after[label.end()]
        if not chain or not label or len(label.group()) < 2 or not label.group().isalpha():
            continue
        left, at = [], m.start()
        while True:
            while at > 0 and (text[at - 1].isalnum() and text[at - 1].isascii() or text[at - 1] in "_%+-."):
                at -= 1
            if at not in before:
                break
            left.append((before[at], at, "."))
            at = before[at]
        yield from reversed(left)
        yield m.start(), m.end(), "@"
        yield from chain


def addresses(source: Rewritten) -> Rewritten:
    """`at` and `dot` disguises read as `@` and `.`."""
    text = source.text
    if not _MAYBE_MAIL.search(text):
        return source
    edits = [(m.start(), m.end(), "@") for m in _AT_MARK.finditer(text)]
    edits += [(m.start(), m.end(), ".") for m in _DOT_MARK.finditer(text)]
    edits += _said_addresses(text)
    return Rewritten(text, _apart(edits), source)


_TOKEN = rf"(?:(?:(?:double|triple)\s{{1,3}})?{_any(_DIGIT)}(?![^\W_])|[0-9]++)"
_SEP = rf"(?:\s{{1,3}}{_any(DOT_WORDS)}\s{{1,3}}|{_GAP}{_OPEN}{_GAP}(?:{_any(DOT_WORDS)}|\.){_GAP}{_SHUT}{_GAP}|[\s,.()-]{{1,3}})"
_RUN = re.compile(rf"(?i)(?<![^\W_])(?:plus\s{{1,3}})?{_TOKEN}(?:{_SEP}{_TOKEN}){{3,}}+(?![^\W_])")
_PIECES = re.compile(rf"(?i)(plus\s{{1,3}})|({_TOKEN})|({_SEP})")
_SPELLED = re.compile(rf"(?i){_any(_DIGIT)}")
_TIMES = {"double": 2, "triple": 3}
#: Letters that stand for a digit inside a number.
_MIXED = re.compile(r"(?<![^\W_])(?=[OoIl]*[0-9])[0-9]*+(?:[OoIl]+[0-9]*+)++(?![^\W_])")
_AS_DIGITS = str.maketrans("OoIl", "0011")


def _said_numbers(text: str) -> Iterator[tuple[int, int, str]]:
    """Edits for runs of at least four digits or numbers, some of them in words: gaps beside words vanish, said dots stay."""
    if not _SPELLED.search(text):
        return
    for run in _RUN.finditer(text):
        pieces = list(_PIECES.finditer(text, run.start(), run.end()))
        said = [m.group(2) is not None and not m.group(2).isdigit() for m in pieces]
        if not any(said):
            continue
        for i, m in enumerate(pieces):
            if m.group(1):
                yield m.start(), m.end(), "+"
            elif said[i]:
                *times, word = m.group(2).lower().split()
                yield m.start(), m.end(), _DIGIT[word] * (_TIMES[times[0]] if times else 1)
            elif m.group(3):
                dot = "." in m.group(3) or any(c.isalpha() for c in m.group(3))
                if dot or said[i - 1] or i + 1 < len(said) and said[i + 1]:
                    yield m.start(), m.end(), "." if dot else ""


def numbers(source: Rewritten) -> Rewritten:
    """Spelled digits, look-alike letters in numbers and said or bracketed dots read as digits and `.`."""
    text = source.text
    edits = list(_said_numbers(text))
    edits += [(m.start(), m.end(), m.group().translate(_AS_DIGITS)) for m in _MIXED.finditer(text)]
    edits += [(m.start(), m.end(), ".") for m in _DOT_MARK.finditer(text)]
    if not edits:
        return source
    return Rewritten(text, _apart(edits), source)


def _apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits in order, without those that overlap an earlier one."""
    out, done = [], 0
    for edit in sorted(edits):
        if edit[0] >= done:
            out.append(edit)
            done = edit[1]
    return out


def find(text: str | None) -> list[tuple[int, int, int, bool]]:
    """(start, index of kind, end, base) of all identifiers of a text, by start, then kind."""
    if not text:
        return []
    spans = [(a, k, b, True) for a, k, b in detect(text)]
    plain = characters(text)
    for form, kinds in ((addresses(plain), KINDS[:1]), (numbers(plain), KINDS[1:])):
        if form.source is None and form.text is text:
            continue
        for a, k, b in detect(form.text, kinds):
            lo, hi, rewritten = form.back(a, b)
            if rewritten and not any(k == s[1] and s[0] <= lo and hi <= s[2] for s in spans):
                spans.append((lo, k, hi, False))
    return sorted(spans)


# Spark


def find_pii(
    frame: DataFrame,
    text_col: str = "text",
    spans_col: str = "spans",
    masked_col: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """The rows with their spans of personal data and, if named, a copy of the text with those overwritten by `*`.

    The copy has as many code points as the text, so spans fit both.  NULL
    and empty texts have no spans, and stay.  Each row is judged by itself:
    repeated rows and ids, ties and empty tables need no rule.  Other
    columns are passed on (the text unless ``keep_text`` is off); one with a
    new column's name is an error.
    """
    new = [spans_col] + ([masked_col] if masked_col else [])
    passed = [i for i, c in enumerate(frame.columns) if keep_text or c != text_col]
    clash = set(new) & {frame.columns[i] for i in passed}
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be replaced")
    schema = StructType([frame.schema.fields[i] for i in passed]).add(spans_col, SPANS)
    if masked_col:
        schema = schema.add(masked_col, "string")
    place = frame.columns.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def scan(batches):
        for batch in batches:
            found, masked = [], []
            for value in batch.column(place):
                text = value.as_py()
                spans = find(text)
                found.append([{"kind": KINDS[k], "start": a, "end": b, "base": base} for a, k, b, base in spans])
                if masked_col:
                    for a, _, b, _ in spans:
                        text = text[:a] + "*" * (b - a) + text[b:]
                    masked.append(text)
            columns = [*[batch.column(i) for i in passed], pa.array(found, kind)]
            if masked_col:
                columns.append(pa.array(masked, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(frame, scan, schema)
