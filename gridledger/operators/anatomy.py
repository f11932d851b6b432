"""Anatomy of project labels: road stations and coordinates are taken out of the title into fields.

A label is read by two small readers. The station reader walks the label's signs without spaces and tries, wherever a
station word stands, the one rule that all kinds share: word, number, plus, offset, and perhaps a second station after a
dash. The coordinate reader cuts the label into signs (numbers, marks, hemispheres, brackets), reads angles from them,
and takes two angles for a place if what they say of themselves (hemispheres, brackets, fractions, bounds) suffices.
What a reader found is cut out, and the title is put together again from the words and signs that are left.

Both need look-alike digits and places in a text, so they run in Arrow batches; native cues let only labels
through that may hold something.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.functions import lexical

# Signs that recognition mistakes for digits, dashes, bounds of the country.
LOOKALIKES = {"O": "0", "o": "0", "I": "1", "l": "1", "L": "1", "|": "1", "S": "5", "s": "5", "B": "8", "Z": "2", "z": "2", "G": "6"}
STATION_LOOKALIKES = {**LOOKALIKES, "!": "1", "?": "7"}
DASHES = "·•∙●–—−∼~〜"
LAT, LON = (4.0, 22.0), (116.0, 128.0)
TITLE_LETTERS = 3

_DASH = str.maketrans({c: "-" for c in DASHES})


@dataclass(frozen=True)
class Span:
    """What was found in text[start:stop]."""

    start: int
    stop: int
    value: dict


def from_the_left(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The taken spans and those others that overlap none, from the left, longer ones first where they start together."""
    out = list(taken)
    for s in sorted(spans, key=lambda s: (s.start, -s.stop)):
        if not any(s.start < t.stop and t.start < s.stop for t in out):
            out.append(s)
    return sorted(out, key=lambda s: s.start)


# ---- titles ----------------------------------------------------------------------------------------------
_SIGNS = ",-()/;"


def _pieces(text: str, spans: list[Span]) -> list[list]:
    """[piece, spaced] of the text outside the spans: words and single signs, and whether space or a span lies before."""
    out, spaced, at, holes = [], False, 0, {s.start: s.stop for s in spans if s.stop > s.start}
    while at < len(text):
        if at in holes:
            at, spaced = holes[at], True
            continue
        c = text[at]
        at += 1
        if c.isspace():
            spaced = True
        elif c in _SIGNS or not out or spaced or out[-1][0] in _SIGNS:
            out.append([c, spaced])
            spaced = False
        else:
            out[-1][0] += c
    return out


def _without_empty_brackets(pieces: list[list]) -> list[list]:
    out: list[list] = []
    for piece, spaced in pieces:
        if piece == ")":
            k = len(out)
            while k and out[k - 1][0] in ",;/":
                k -= 1
            if k and out[k - 1][0] == "(":
                del out[k - 1 :]
                continue
        out.append([piece, spaced])
    return out


def _with_single_separators(pieces: list[list]) -> list[list]:
    """A comma takes one dash on either side with it, two dashes are one, and so are any commas in a row."""
    near: list[list] = []
    for piece, spaced in pieces:
        if piece == "," and near and near[-1][0] == "-":
            near.pop()
        near.append([piece, spaced])
    out: list[list] = []
    eaten = paired = False
    for piece, spaced in near:
        last = out[-1][0] if out else ""
        if piece == "-" and last == "," and not eaten:
            eaten = True
            continue
        if piece == "-" and last == "-" and not paired:
            out[-1][1] = paired = True
            continue
        if piece == "," and last == ",":
            eaten = True
            continue
        # What follows a separator that stands for several is set apart from it.
        out.append([piece, spaced or eaten or paired])
        eaten = paired = False
    return out


def without(text: str, spans: list[Span]) -> str:
    """The text without its spans: emptied brackets and left-over separators go, at the ends all of them."""
    pieces = _with_single_separators(_without_empty_brackets(_pieces(text, spans)))
    if pieces and pieces[-1][0].endswith("."):
        pieces[-1][0] = pieces[-1][0][:-1]
        if not pieces[-1][0]:
            pieces.pop()
    for end in (-1, 0):
        while pieces and pieces[end][0] in (",", "-", ";", "/"):
            pieces.pop(end)
    for end, bracket in ((-1, "("), (0, ")")):
        if pieces and pieces[end][0] == bracket:
            pieces.pop(end)
            if pieces and pieces[end][0] == ",":
                pieces.pop(end)
    return "".join((" " if spaced and k and piece != "," else "") + piece for k, (piece, spaced) in enumerate(pieces))


# ---- road stations ---------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Road:
    """How stations of a kind are written: their words, how many digits follow, whether an offset must."""

    kind: str
    words: tuple[str, ...]
    least: int = 1
    most: int = 99
    digits: frozenset = frozenset("0123456789") | frozenset(STATION_LOOKALIKES)
    offset: bool = True
    prefix: str = ""
    may_drop_word: bool = False
    may_break_off: bool = False


# The kinds of stations.
ROADS = (
    Road("K", ("K",), 2, 5, may_break_off=True),
    Road("KM", ("KM",)),
    Road("Sta", ("STA.", "STA"), may_drop_word=True),
    Road("C", ("C",), 1, 1, frozenset("0Oo"), prefix="C"),
    Road("Chainage", ("CHAINAGE", "CHAINAQE"), offset=False, may_drop_word=True, may_break_off=True),
)
_DIGITS = Road("", ()).digits


@dataclass(frozen=True)
class Station:
    stop: int
    text: str | None
    has_offset: bool


class StationReader:
    """Reads stations at places of a text without spaces."""

    def __init__(self, text: str):
        self.text, self.upper = text, text.upper()

    def run(self, at: int, digits: frozenset = _DIGITS) -> int:
        while at < len(self.text) and self.text[at] in digits:
            at += 1
        return at

    def number(self, start: int, stop: int) -> str:
        return "".join(STATION_LOOKALIKES.get(c, c) for c in self.text[start:stop])

    def decimal(self, at: int) -> int | None:
        """The end of digits and perhaps a fraction."""
        stop = self.run(at)
        if stop == at:
            return None
        more = self.run(stop + 1) if self.text[stop : stop + 1] == "." else stop + 1
        return more if more > stop + 1 else stop

    def offset(self, at: int) -> int | None:
        """The end of an offset: a decimal, or one in brackets that may be negative."""
        if self.text[at : at + 1] != "(":
            return self.decimal(at)
        inner = at + 2 if self.text[at + 1 : at + 2] == "-" else at + 1
        stop = self.decimal(inner)
        return stop + 1 if stop is not None and self.text[stop : stop + 1] == ")" else None

    def after_word(self, road: Road, at: int) -> int | None:
        return next((at + len(w) for w in road.words if self.upper.startswith(w, at)), None)

    def place(self, road: Road, at: int, with_offset: bool) -> Station | None:
        """A number and its offset, without the word."""
        stop = self.run(at, road.digits)
        if not road.least <= stop - at <= road.most:
            return None
        text = road.prefix + self.number(at, stop)
        if not with_offset:
            return Station(stop, text, False)
        end = self.offset(stop + 1) if self.text[stop : stop + 1] == "+" else None
        return end and Station(end, f"{text}+{self.number(stop + 1, end)}", True)

    def station(self, road: Road, at: int) -> Station | None:
        first = self.after_word(road, at)
        if first is None:
            return None
        return self.place(road, first, True) or (None if road.offset else self.place(road, first, False))

    def second(self, road: Road, first: Station, at: int) -> tuple[Station, bool] | None:
        """What follows the dash of a range, and whether it is complete."""
        word = self.after_word(road, at)
        start = word if word is not None else at if road.may_drop_word else None
        whole = None if start is None else self.place(road if word is not None else ROADS[1], start, first.has_offset)
        if whole:
            return whole, True
        if word is None or not road.may_break_off:
            return None
        digits = min(self.run(word, road.digits) - word, road.most)
        if not road.offset:  # only the word is there
            return None if digits else (Station(word, None, False), False)
        if digits < road.least:
            return None
        stop = word + digits
        plus = self.text[stop : stop + 1] == "+"
        return Station(stop + plus, self.number(word, stop + plus), False), False

    def ranges(self, at: int) -> Iterator[Span]:
        for road in ROADS:
            first = self.station(road, at)
            joint = next((w for w in ("-", "TO") if first and self.upper.startswith(w, first.stop)), None)
            second = joint and self.second(road, first, first.stop + len(joint))
            if second:
                yield Span(at, second[0].stop, {"kind": road.kind, "from": first.text, "to": second[0].text, "incomplete": not second[1]})

    def singles(self, at: int) -> Iterator[Span]:
        for road in ROADS:
            found = self.station(road, at)
            if found:
                yield Span(at, found.stop, {"kind": road.kind, "from": found.text, "to": None, "incomplete": False})


_LEADS = frozenset(w[0] for road in ROADS for w in road.words)


def stations(label: str | None) -> tuple[str, list[dict]]:
    """(title without them, [{kind, from, to, incomplete}]). Stations are read from the text without spaces; ranges go before single ones."""
    raw = (label or "").translate(_DASH)
    at = [i for i, c in enumerate(raw) if not c.isspace()]
    reader = StationReader("".join(raw[i] for i in at))
    leads = [i for i, c in enumerate(reader.upper[: len(at)]) if c in _LEADS]
    found = from_the_left([s for i in leads for s in reader.ranges(i)], [])
    found = from_the_left([s for i in leads for s in reader.singles(i)], found)
    spans = [Span(at[s.start], at[s.stop - 1] + 1, s.value) for s in found]
    letters = lambda s: sum(c.isalpha() for c in s)
    title = without(raw, spans) if spans else raw.strip()
    if spans and letters(title) < TITLE_LETTERS and letters(raw) >= TITLE_LETTERS + 2:
        return raw.strip(), []  # a title is never eaten whole
    return title, [s.value for s in spans]


# ---- coordinates -----------------------------------------------------------------------------------------
_MARKS = {"°": "degree", "º": "degree", "'": "minute", "′": "minute", '"': "second", "″": "second", ",": "comma", ";": "semicolon", "(": "open", ")": "close", ".": "point", ":": "colon"}
_DIGIT_LIKE = frozenset("0123456789") | frozenset(LOOKALIKES)


@dataclass(frozen=True)
class Sign:
    """A sign of a label: run (of digits and look-alikes), hemisphere, word, or a mark; and whether space stands before."""

    kind: str
    start: int
    stop: int
    text: str
    spaced: bool


def signs(text: str) -> list[Sign]:
    out: list[Sign] = []

    def add(kind: str, start: int, stop: int) -> None:
        out.append(Sign(kind, start, stop, text[start:stop], start > 0 and text[start - 1].isspace()))

    at = 0
    while at < len(text):
        if not (text[at].isalnum() or text[at] in "_|"):
            if not text[at].isspace():
                add(_MARKS.get(text[at], "word"), at, at + 1)
            at += 1
            continue
        stop = at
        while stop < len(text) and (text[stop].isalnum() or text[stop] in "_|"):
            stop += 1
        # Within a chunk: a word perhaps, a run from its first digit on, and a hemisphere or the rest.
        first = at if text[at] in _DIGIT_LIKE and all(c in _DIGIT_LIKE or c in "NEWnew" for c in text[at:stop]) else next((i for i in range(at, stop) if text[i] in "0123456789"), stop)
        end = first
        while end < stop and text[end] in _DIGIT_LIKE:
            end += 1
        if stop - at == 1 and text[at] in "NSEWnsew":
            add("hemisphere", at, stop)
        else:
            for kind, a, b in (("word", at, first), ("run", first, end), ("hemisphere" if stop - end == 1 and text[end] in "NSEWnsew" and not text[end - 1].isalpha() else "word", end, stop)):
                if b > a:
                    add(kind, a, b)
        at = stop
    return out


@dataclass(frozen=True)
class Angle:
    """A decimal or sexagesimal angle as read, its hemisphere if it says one, and what its writing shows."""

    start: int
    stop: int
    value: float
    hemisphere: str | None
    sexagesimal: bool
    fraction: bool
    real: bool  # look-alikes alone are no number


class CoordinateReader:
    """Reads angles and places at signs of a text; every method returns what it read and the next sign's index, or None."""

    def __init__(self, text: str):
        self.text, self.signs = text, signs(text)

    def kind(self, i: int) -> str:
        return self.signs[i].kind if i < len(self.signs) else "end"

    def skip(self, i: int, *kinds: str) -> int:
        return i + 1 if self.kind(i) in kinds else i

    def decimal(self, i: int) -> tuple[str, int] | None:
        """Digits, perhaps with a point and more of them."""
        if self.kind(i) != "run":
            return None
        if self.kind(i + 1) == "point" and self.kind(i + 2) == "run":
            return f"{self.signs[i].text}.{self.signs[i + 2].text}", i + 3
        return self.signs[i].text, i + 1

    @staticmethod
    def plain(text: str) -> float:
        return float("".join(LOOKALIKES.get(c, c) for c in text))

    def hemisphere(self, text: str, i: int, wanted: str) -> tuple[str, str, int] | None:
        """A number's text, its hemisphere and the next sign. A last S that could be a digit may be one."""
        if self.kind(i) == "hemisphere" and self.signs[i].text.upper() in wanted:
            return text, self.signs[i].text.upper(), i + 1
        if "S" in wanted and text[-1:] in ("S", "s") and len(text) > 1 and not text[-2].isalpha() and text[-2] != ".":
            return text[:-1], "S", i
        return None

    def angle(self, i: int, first: bool, wanted: str | None) -> tuple[Angle, int] | None:
        """An angle in the wanted hemispheres, or one that says none. The first of a place may begin inside a longer run."""
        read = self.decimal(i)
        if read is None:
            return None
        text, j = read
        whole = len(text.partition(".")[0])
        start = self.signs[i].start
        if whole > 3:
            if not first:
                return None
            start, text = start + whole - 3, text[whole - 3 :]
        stop = lambda j: self.signs[j - 1].stop
        real, fraction = (lambda t: any(c.isdigit() for c in t)), "." in text
        if wanted is None:
            j = self.skip(j, "degree")
            return Angle(start, stop(j), self.plain(text), None, False, fraction, real(text)), j
        if self.kind(j) == "degree":
            sexagesimal = self.sexagesimal(text, j + 1, wanted)
            if sexagesimal:
                value, side, k = sexagesimal
                return Angle(start, stop(k), value, side, True, fraction, True), k
        side = self.hemisphere(text, self.skip(j, "degree"), wanted)
        return side and (Angle(start, stop(side[2]), self.plain(side[0]), side[1], False, fraction, real(side[0])), side[2])

    def sexagesimal(self, degrees: str, i: int, wanted: str) -> tuple[float, str, int] | None:
        """The value from the minutes on; a minute mark that went missing leaves four or three digits together."""
        read = self.decimal(i)
        if read is None:
            return None
        text, j = read
        if self.kind(j) == "minute" and "." not in text and len(text) <= 2:
            minutes, rest = text, self.decimal(j + 1)
            if rest is None or len(rest[0].partition(".")[0]) > 3:
                return None
            seconds, j = rest[0], self.skip(rest[1], "second", "degree")
        else:
            whole = text.partition(".")[0]
            if wanted != "EW" or len(whole) not in (3, 4) or not any(c.isdigit() for c in text):
                return None
            minutes, seconds = whole[:-2], text[len(whole) - 2 :]
        side = self.hemisphere(seconds, j, wanted)
        if side is None:
            return None
        m, s = self.plain(minutes), self.plain(side[0])
        return (abs(self.plain(degrees)) + m / 60 + s / 3600, side[1], side[2]) if m < 60 and s < 60 else None

    def places(self, i: int) -> Iterator[Span]:
        """All that may begin at a sign."""
        if self.kind(i) == "open":
            role = self.signs[i + 1].text.upper() if self.kind(i + 2) == "colon" else None
            if role in ("LS", "RS"):
                yield from self.with_sides(i + 3, self.signs[i].start, role)
            yield from self.with_sides(i + 1, self.signs[i].start, None)
            yield from self.in_brackets(i)
            yield from self.cut_off(i)
        elif self.kind(i) == "run":
            yield from self.with_sides(i, None, None)
            yield from self.bare(i)

    def span(self, start: int, stop: int, lat: float | None, lon: float | None, kind: str, swapped: bool = False, role: str | None = None, incomplete: bool = False) -> Span:
        r = lambda v: None if v is None else round(v, 7)
        return Span(start, stop, {"lat": r(lat), "lon": r(lon), "raw": self.text[start:stop].strip(), "kind": kind, "role": role, "swapped": swapped, "incomplete": incomplete})

    def with_sides(self, i: int, bracket: int | None, role: str | None) -> Iterator[Span]:
        """Two angles with hemispheres, north or south first; a role needs its bracket closed."""
        a = self.angle(i, bracket is None, "NS")
        if a is None or self.kind(a[1]) != "comma":
            return
        b = self.angle(a[1] + 1, False, "EW")
        if b is None:
            return
        (a, _), (b, j) = a, b
        closed = self.kind(j) == "close"
        if a.sexagesimal != b.sexagesimal or (role and not closed):
            return
        if a.sexagesimal:
            sound = role is None and in_country(signed(a), signed(b))
        elif role:
            sound = a.real and b.real
        else:
            sound = a.fraction and b.fraction and a.real and b.real and (in_country(a.value, b.value) or (LAT[0] <= a.value <= LAT[1] and 100 <= b.value <= 140))
        if sound:
            start = a.start if bracket is None else bracket
            yield self.span(start, self.signs[j].stop if closed else b.stop, signed(a), signed(b), "dms" if a.sexagesimal else "decimal_hem", role=role)

    def in_brackets(self, i: int) -> Iterator[Span]:
        """Two decimals in brackets, at least one of them with a fraction; a longitude may have lost its hundred."""
        a = self.angle(i + 1, False, None)
        if a is None:
            return
        j = self.skip(a[1], "minute")
        apart = j < len(self.signs) and self.signs[j].spaced
        if self.kind(j) in ("comma", "semicolon"):
            apart = self.kind(j) == "comma" or (j + 1 < len(self.signs) and self.signs[j + 1].spaced)
            j += 1
        b = self.angle(j, False, None) if apart else None
        if b is None or self.kind(b[1]) != "close":
            return
        (a, _), (b, j) = a, b
        if not (a.real and b.real and (a.fraction or b.fraction)):
            return
        for x, y in ((0, 0), (100, 0), (0, 100)):
            if (not x or 20 <= a.value <= 29) and (not y or 20 <= b.value <= 29) and in_country(a.value + x, b.value + y):
                lat, lon, swapped = ordered(a.value + x, b.value + y)
                yield self.span(self.signs[i].start, self.signs[j].stop, lat, lon, "decimal", swapped)
                return

    def bare(self, i: int) -> Iterator[Span]:
        """Two decimals with fractions within the country, after no word or point and before no hemisphere."""
        before = self.signs[i].start - 1
        if before >= 0 and (self.text[before].isalnum() or self.text[before] in "_."):
            return
        a = self.angle(i, False, None)
        if a is None or self.kind(a[1]) != "comma":
            return
        b = self.angle(a[1] + 1, False, None)
        if b is None or self.text[b[0].stop :].lstrip()[:1] in tuple("NSns"):
            return
        (a, _), (b, _) = a, b
        if a.fraction and b.fraction and a.real and b.real and in_country(a.value, b.value):
            lat, lon, swapped = ordered(a.value, b.value)
            yield self.span(a.start, b.stop, lat, lon, "decimal", swapped)

    def cut_off(self, i: int) -> Iterator[Span]:
        """A bracket that the label's end cuts off: an angle, perhaps its hemisphere, a comma and a second one."""
        plain = self.angle(i + 1, False, None)
        if plain is None:
            return
        (a, j), b = plain, None
        j = self.skip(self.skip(j, "degree"), "comma")
        if self.kind(j) != "end":
            north = self.angle(i + 1, False, "NS")
            if north is None or north[0].sexagesimal or self.kind(north[1]) != "comma":
                return
            a, j = north
            b = self.angle(j + 1, False, None)
            j = b[1] if b else j + 1
        if self.kind(j) != "end":
            return
        if b:
            lat, lon = signed(a), b[0].value
        else:
            lat = a.value if LAT[0] <= a.value <= LAT[1] else None
            lon = a.value if LON[0] <= a.value <= LON[1] else None
        yield self.span(self.signs[i].start, len(self.text), lat, lon, "decimal", incomplete=True)


def signed(a: Angle) -> float:
    return -abs(a.value) if a.hemisphere in ("S", "W") else abs(a.value)


def in_country(a: float, b: float) -> bool:
    """Whether one is a latitude and the other a longitude of the country."""
    return any(LAT[0] <= x <= LAT[1] and LON[0] <= y <= LON[1] for x, y in ((a, b), (b, a)))


def ordered(a: float, b: float) -> tuple[float, float, bool]:
    """Latitude, longitude, and whether they came the other way round; for pairs in the country."""
    return (b, a, True) if a > b else (a, b, False)


def coordinates(label: str | None) -> tuple[str, list[dict]]:
    """(title without them, [{lat, lon, raw, kind, role, swapped, incomplete}])."""
    text = label or ""
    reader = CoordinateReader(text)
    chosen = from_the_left([s for i in range(len(reader.signs)) for s in reader.places(i)], [])
    return (without(text, chosen) if chosen else text.strip()), [s.value for s in chosen]


# ---- on tables -------------------------------------------------------------------------------------------
STATION_TYPE = "array<struct<kind:string,from:string,to:string,incomplete:boolean>>"
COORDINATE_TYPE = "array<struct<lat:double,lon:double,raw:string,kind:string,role:string,swapped:boolean,incomplete:boolean>>"


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        titles, chains, points = [], [], []
        for label in pdf["label"]:
            title, chain = stations(label)
            title, point = coordinates(title)
            titles.append(title)
            chains.append(chain)
            points.append(point)
        yield pd.DataFrame({"id": pdf["id"], "label": titles, "label_ocr": pdf["label"], "chainages": chains, "coordinates": points})


def label_anatomy(labels: DataFrame) -> DataFrame:
    """id, label (title), label_ocr (as it was, if touched), chainages, coordinates. labels: id, label.

    Only labels with a cue go through Python; the others are cleaned natively.
    """
    cue = lexical.chainage_cue(F.col("label")) | lexical.coordinate_cue(F.col("label"))
    schema = f"id string, label string, label_ocr string, chainages {STATION_TYPE}, coordinates {COORDINATE_TYPE}"
    rows = labels.select(F.col("id").cast("string").alias("id"), lexical.clean(F.col("label")).alias("label"))
    read = rows.where(cue).mapInPandas(_parsed, schema)
    untouched = (F.size("chainages") == 0) & (F.size("coordinates") == 0)
    read = read.withColumns({"label": F.when(untouched, F.col("label_ocr")).otherwise(F.col("label")), "label_ocr": F.when(untouched, F.lit(None)).otherwise(F.col("label_ocr"))})
    plain = rows.where(~cue).select("id", "label", F.lit(None).cast("string").alias("label_ocr"), F.array().cast(STATION_TYPE).alias("chainages"), F.array().cast(COORDINATE_TYPE).alias("coordinates"))
    return read.unionByName(plain)


def anatomy_stats(parsed: DataFrame) -> DataFrame:
    """n_stripped, n_chainage, n_gps of label_anatomy()."""
    return parsed.agg(F.count("label_ocr").alias("n_stripped"), F.count_if(F.size("chainages") > 0).alias("n_chainage"), F.count_if(F.size("coordinates") > 0).alias("n_gps"))


def split_lines(lines: DataFrame) -> DataFrame:
    """id, title, description: labels whose first line is a title and whose other lines describe it; else one title.

    lines: id, line_no, text, run_gap_pt, run_gap_spaces.
    """
    l = F.array_sort(F.collect_list(F.struct("line_no", "text", "run_gap_pt", "run_gap_spaces"))).alias("l")  # noqa: E741
    g = lines.groupBy("id").agg(l)
    a, b = F.get("l", F.lit(0)), F.get("l", F.lit(1))
    two = F.coalesce((F.size("l") >= 2) & lexical.splits_title(a["text"], a["run_gap_pt"], a["run_gap_spaces"], b["text"]), F.lit(False))
    rest = lexical.clean(F.concat_ws(" ", F.slice(F.col("l.text"), 2, F.greatest(F.size("l") - 1, F.lit(1)))))
    return g.select("id", F.when(two, lexical.clean(a["text"])).otherwise(lexical.clean(F.concat_ws(" ", "l.text"))).alias("title"), F.when(two & (rest != ""), rest).alias("description"))


def enriched_labels(lines: DataFrame) -> DataFrame:
    """id, label, label_ocr, description, chainages, coordinates: titles and descriptions split, then both read.

    lines as in split_lines(). label_ocr is the whole label if anything was taken out of it.
    """
    split = split_lines(lines)
    title = label_anatomy(split.select(F.col("id").cast("string").alias("id"), F.col("title").alias("label")))
    rest = label_anatomy(split.where(F.col("description").isNotNull()).select(F.col("id").cast("string").alias("id"), F.col("description").alias("label"))).select("id", F.col("label").alias("description"), F.col("chainages").alias("more_chainages"), F.col("coordinates").alias("more_coordinates"))
    whole = lines.groupBy(F.col("id").cast("string").alias("id")).agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("l")).select("id", lexical.clean(F.concat_ws(" ", "l.text")).alias("whole"))
    both = title.drop("label_ocr").join(rest, "id", "left").join(whole, "id")
    chains = F.concat("chainages", F.coalesce("more_chainages", F.array().cast(STATION_TYPE)))
    points = F.concat("coordinates", F.coalesce("more_coordinates", F.array().cast(COORDINATE_TYPE)))
    touched = F.col("description").isNotNull() | (F.size(chains) > 0) | (F.size(points) > 0)
    return both.select("id", "label", F.when(touched, F.col("whole")).alias("label_ocr"), F.when(F.col("description") != "", F.col("description")).alias("description"), chains.alias("chainages"), points.alias("coordinates"))
