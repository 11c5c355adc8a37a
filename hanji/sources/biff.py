"""The first sheet of a legacy spreadsheet (.xls, BIFF8) as rows of strings."""

from __future__ import annotations

import datetime
import re
import struct
from collections.abc import Iterator

from . import compound

# The format's record numbers, and the numbers of its built-in date formats.
BOUND_SHEET, DATE_1904, SHARED, CONTINUE, FORMAT, XF, END = 0x85, 0x22, 0xFC, 0x3C, 0x41E, 0xE0, 0x0A
LABEL_SHARED, LABEL, RICH, NUMBER, RK, MANY_RK, FORMULA, TEXT_RESULT, BOOL = 0xFD, 0x204, 0xD6, 0x203, 0x27E, 0xBD, 0x06, 0x207, 0x205
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
MAX_BOOK = 256 << 20


def records(data: bytes, at: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """(number, body and what continues it) of each record."""
    held: tuple[int, list[bytes]] | None = None
    while at + 4 <= len(data):
        number, size = struct.unpack_from("<HH", data, at)
        body, at = data[at + 4 : at + 4 + size], at + 4 + size
        if number == CONTINUE and held:
            held[1].append(body)
            continue
        if held:
            yield held
        held = number, [body]
    if held:
        yield held


class Parts:
    """A reader over a record and its continuations. Characters that go on in the next part have their width told anew."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.k, self.at = parts, 0, 0

    def step(self) -> None:
        while self.at >= len(self.parts[self.k]) and self.k + 1 < len(self.parts):
            self.k, self.at = self.k + 1, 0

    def take(self, n: int) -> bytes:
        out = b""
        while n > len(out):
            self.step()
            piece = self.parts[self.k][self.at : self.at + n - len(out)]
            if not piece:
                raise ValueError("a record ends early")
            out, self.at = out + piece, self.at + len(piece)
        return out

    def text(self, length: int) -> str:
        flags, = self.take(1)
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        more = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out, wide = [], flags & 1
        while length:
            if self.at >= len(self.parts[self.k]):
                self.step()
                wide = self.take(1)[0] & 1
            n = min(length, (len(self.parts[self.k]) - self.at) // (1 + wide))
            if not n:
                raise ValueError("a string ends early")
            out.append(self.take(n * (1 + wide)).decode("utf-16-le" if wide else "latin-1", "replace"))
            length -= n
        self.take(4 * runs + more)
        return "".join(out)


def number_of(rk: int) -> float:
    """A number packed into 30 bits: an integer, or a double's upper half; perhaps in hundredths."""
    value = float((rk if rk < 1 << 31 else rk - (1 << 32)) >> 2) if rk & 2 else struct.unpack("<d", struct.pack("<Q", (rk & 0xFFFFFFFC) << 32))[0]
    return value / 100 if rk & 1 else value


def shown(value: float, dated: bool, base: datetime.datetime) -> str:
    """A number as text: a date where its format says so, without decimals where it has none."""
    if dated and 0 <= value < 2_958_466:
        return str(base + datetime.timedelta(seconds=round(value * 86_400)))
    return str(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value)


def rows_of(data: bytes) -> list[list[str | None]]:
    """The cells of the workbook's first sheet. Formulas count by their stored results."""
    found = compound.streams(data, MAX_BOOK)
    book = found.get("Workbook") or found.get("Book")
    if not book:
        raise ValueError("no workbook in the file")
    sheets, shared, formats, styles, base = [], [], {}, [], datetime.datetime(1899, 12, 30)
    for number, parts in records(book):
        body = parts[0]
        if number == BOUND_SHEET and body[5] == 0:
            sheets.append(struct.unpack_from("<I", body)[0])
        elif number == DATE_1904 and body[:2] == b"\x01\x00":
            base = datetime.datetime(1904, 1, 1)
        elif number == FORMAT:
            formats[struct.unpack_from("<H", body)[0]] = Parts([body[4:]]).text(struct.unpack_from("<H", body, 2)[0])
        elif number == XF:
            styles.append(struct.unpack_from("<H", body, 2)[0])
        elif number == SHARED:
            reader = Parts(parts)
            reader.take(4)
            shared = [reader.text(struct.unpack("<H", reader.take(2))[0]) for _ in range(struct.unpack("<I", reader.take(4))[0])]
        elif number == END:
            break
    if not sheets:
        raise ValueError("no sheet in the workbook")
    spoken = {k for k, f in formats.items() if re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.lower()))}
    dated = lambda style: style < len(styles) and styles[style] in DATE_FORMATS | spoken
    cells: dict[tuple[int, int], str] = {}
    last = None
    for number, parts in records(book, sheets[0]):
        body = parts[0]
        if number == END:
            break
        if number == TEXT_RESULT and last is not None:
            cells[last] = Parts([body[2:], *parts[1:]]).text(struct.unpack_from("<H", body)[0])
        if number not in (LABEL_SHARED, LABEL, RICH, NUMBER, RK, MANY_RK, FORMULA, BOOL):
            continue
        row, column, style = struct.unpack_from("<3H", body)
        if number == LABEL_SHARED:
            cells[row, column] = shared[struct.unpack_from("<I", body, 6)[0]]
        elif number in (LABEL, RICH):
            cells[row, column] = Parts([body[8:], *parts[1:]]).text(struct.unpack_from("<H", body, 6)[0])
        elif number == NUMBER:
            cells[row, column] = shown(struct.unpack_from("<d", body, 6)[0], dated(style), base)
        elif number == RK:
            cells[row, column] = shown(number_of(struct.unpack_from("<I", body, 6)[0]), dated(style), base)
        elif number == MANY_RK:
            for k in range((len(body) - 6) // 6):
                style, rk = struct.unpack_from("<HI", body, 4 + 6 * k)
                cells[row, column + k] = shown(number_of(rk), dated(style), base)
        elif number == BOOL and body[7] == 0:
            cells[row, column] = str(bool(body[6]))
        elif number == FORMULA:
            last = (row, column)
            if body[12:14] != b"\xff\xff":
                cells[row, column] = shown(struct.unpack_from("<d", body, 6)[0], dated(style), base)
            elif body[6] == 1:
                cells[row, column] = str(bool(body[8]))
    width: dict[int, int] = {}
    for row, column in cells:
        width[row] = max(width.get(row, 0), column + 1)
    return [[cells.get((row, k)) for k in range(width.get(row, 0))] for row in range(max(width, default=-1) + 1)]
