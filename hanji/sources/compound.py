"""The compound-file container of older office formats."""

from __future__ import annotations

import struct

#: Fixed value: the container's signature.
SIGNATURE = bytes.fromhex("D0CF11E0A1B11AE1")


def streams(data: bytes, longest: int) -> dict[str, bytes | None]:
    """All streams of a compound file by their path; null for those of more than `longest` bytes, which aren't read."""
    if data[:8] != SIGNATURE:
        raise ValueError("no compound file")
    big, small = 1 << struct.unpack_from("<H", data, 30)[0], 1 << struct.unpack_from("<H", data, 32)[0]
    first_dir, = struct.unpack_from("<I", data, 48)
    cutoff, first_mini, _, first_difat, _ = struct.unpack_from("<5I", data, 56)
    sector = lambda n: data[(n + 1) * big : (n + 2) * big]
    per = big // 4
    difat = list(struct.unpack_from("<109I", data, 76))
    while first_difat < 0xFFFFFFFA:
        *more, first_difat = struct.unpack(f"<{per}I", sector(first_difat))
        difat += more
    fat = [x for n in difat if n < 0xFFFFFFFA for x in struct.unpack(f"<{per}I", sector(n))]

    def chain(start: int, table: list[int], read) -> bytes:
        out, seen = [], set()
        while start < 0xFFFFFFFA:
            if start in seen or start >= len(table):
                raise ValueError("broken sector chain")
            seen.add(start)
            out.append(read(start))
            start = table[start]
        return b"".join(out)

    directory = chain(first_dir, fat, sector)
    entries = []
    for at in range(0, len(directory), 128):
        size, kind = struct.unpack_from("<HB", directory, at + 64)
        left, right, child = struct.unpack_from("<3I", directory, at + 68)
        start, length = struct.unpack_from("<IQ", directory, at + 116)
        entries.append((directory[at : at + max(size - 2, 0)].decode("utf-16-le", "replace"), kind, left, right, child, start, length))
    mini_data = chain(entries[0][5], fat, sector) if entries[0][6] else b""
    mini_raw = chain(first_mini, fat, sector) if first_mini < 0xFFFFFFFA else b""
    mini_fat = list(struct.unpack(f"<{len(mini_raw) // 4}I", mini_raw))
    found: dict[str, bytes | None] = {}
    todo, seen = [(entries[0][4], "")], set()
    while todo:
        k, prefix = todo.pop()
        if k >= len(entries) or k in seen:
            continue
        seen.add(k)
        name, kind, left, right, child, start, length = entries[k]
        todo += [(left, prefix), (right, prefix)]
        if kind == 1:
            todo.append((child, f"{prefix}{name}/"))
        elif kind == 2 and length > longest:
            found[prefix + name] = None
        elif kind == 2:
            own = chain(start, mini_fat, lambda n: mini_data[n * small : (n + 1) * small]) if length < cutoff else chain(start, fat, sector)
            found[prefix + name] = own[:length]
    return found
